"""Fill-in-middle transformation: DuckDB inside ``mapInArrow``.

Each slice of an Arrow batch is registered with a DuckDB connection of the
task, where one SQL statement cuts the texts into units (runs of letters, or
one other code point), cuts the units into prefix, middle and suffix by a hash
of the doc_id, and joins them around three marks; another statement takes an
output apart again.  No Python runs per row.

Edge cases: a null text is empty; an empty text, or one that holds a mark, is
plain; a null doc_id is cut as the empty id; repeated rows get equal results,
rows that share a doc_id are cut by the same hash; long texts are cut whole;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.common import shared_dir
from spotweave.llm.text import text_slices

#: Fixed marks and unit pattern.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Of 100 documents, those that stay plain and, of the others, those with the suffix first.
PLAIN, SPM = 10, 20
#: Bytes of text that one statement handles, about.
SLICE = 1 << 20

#: Rows (doc_id, text) of ``batch`` to parts and output.
TRANSFORM = f"""
with cut as (select doc_id, text, sha256(concat('1:', coalesce(cast(doc_id as varchar), ''))) as hash, regexp_extract_all(text, '{UNIT}') as units from batch),
drawn as (select doc_id, text, units, len(units) as n,
    [cast(concat('0x', substr(hash, 8 * k + 1, 8)) as bigint) for k in range(4)] as h from cut),
placed as (select doc_id, text, units, n, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
    case when text = '' or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}') or h[3] % 100 >= {100 - PLAIN} then 'plain'
         when h[4] % 100 < {SPM} then 'spm' else 'psm' end as form from drawn),
parts as (select doc_id, text, n, form, array_to_string(list_slice(units, 1, a), '') as prefix, array_to_string(list_slice(units, a + 1, b), '') as middle,
    array_to_string(list_slice(units, b + 1, n), '') as suffix from placed)
select doc_id, cast(n as bigint) as n, form,
    case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars, case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
    case form when 'plain' then text
        when 'psm' then concat('{PREFIX}', prefix, '{SUFFIX}', suffix, '{MIDDLE}', middle)
        else concat('{SUFFIX}', suffix, '{PREFIX}', prefix, '{MIDDLE}', middle) end as output
from parts"""

#: Rows (form, output) of {source} to the text they were made from: the marks occur once each, as no text that holds one is cut.
RESTORE = f"""
with found as (select *, string_split(substr(output, {len(PREFIX) + 1}), case form when 'psm' then '{SUFFIX}' else '{PREFIX}' end) as first from {{source}}),
taken as (select *, first[1] as one, string_split(first[2], '{MIDDLE}') as second from found)
select * exclude (first, one, second), case form when 'plain' then output when 'psm' then concat(one, second[2], second[1]) else concat(second[1], second[2], one) end as restored
from taken"""

DIGESTS = f"""
with transformed as ({TRANSFORM}), rebuilt as ({RESTORE.format(source="transformed")})
select doc_id, n, form, prefix_chars, middle_chars, sha256(output) as output_sha256, sha256(restored) as restored_sha256 from rebuilt"""


def _in_duckdb(df: DataFrame, column: str, sql: str, schema: str) -> DataFrame:
    """``sql`` over ``df`` as the view batch, a slice of about SLICE bytes of ``column`` at a time."""
    shared_dir(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        # One thread beside Spark's own tasks, and no files.
        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as con:
            for rows in text_slices(batches, column, SLICE):
                con.register("batch", pa.Table.from_batches([rows]))
                yield from con.execute(sql).to_arrow_table().to_batches()
                con.unregister("batch")

    return df.mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of ``docs`` (doc_id, text)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _in_duckdb(source, "text", TRANSFORM, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(outputs: DataFrame) -> DataFrame:
    """(doc_id, form, output, restored): the text that each output (form, output) was made from."""
    source = outputs.select(F.col("doc_id").cast("long").alias("doc_id"), "form", "output")
    return _in_duckdb(source, "output", RESTORE.format(source="batch"), "doc_id long, form string, output string, restored string")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): both steps in one statement, and only hashes return."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _in_duckdb(source, "text", DIGESTS, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
