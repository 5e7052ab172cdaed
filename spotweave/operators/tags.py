"""Alignments and their tags: map operations, joins that attach them, and filters.

``tags`` is MAP<STRING, STRUCT<type: STRING, value: STRING>>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = "map<string,struct<type:string,value:string>>"


def value(tag: str) -> Column:
    """The whole value, colons included."""
    return F.col("tags")[tag]["value"]


def with_tag(df: DataFrame, tag: str, v: Column, kind: str = "Z") -> DataFrame:
    """Set a tag where ``v`` isn't NULL."""
    rest = F.map_filter(F.coalesce("tags", F.expr(f"cast(map() as {TAGS})")), lambda k, _: k != tag)
    one = F.create_map(F.lit(tag), F.struct(F.lit(kind).alias("type"), v.cast("string").alias("value")))
    return df.withColumn("tags", F.when(v.isNotNull(), F.map_concat(rest, one)).otherwise(F.col("tags")))


def combine(df: DataFrame, sources: list[str], new: str) -> DataFrame:
    """A tag from the values of others in order; missing ones are empty."""
    return with_tag(df, new, F.concat(*[F.coalesce(value(t), F.lit("")) for t in sources]))


def drop(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumn("tags", F.map_filter("tags", lambda k, _: ~k.isin(names)))


def chromosome_tag(df: DataFrame, tag: str = "GN") -> DataFrame:
    return with_tag(df, tag, F.when(F.col("rname").isin("*", "="), "NA").otherwise(F.col("rname")))


def id_to_tags(df: DataFrame, barcode: str = "CR", umi: str = "UR") -> DataFrame:
    """The last two '_' parts of the read id as tags; the id stays."""
    p = F.split("qname", "_")
    ok = F.size(p) >= 3
    return with_tag(with_tag(df, barcode, F.when(ok, F.element_at(p, -2))), umi, F.when(ok, F.element_at(p, -1)))


def clear_alignment(df: DataFrame) -> DataFrame:
    """Unmapped constants in the alignment fields."""
    return df.withColumns({"flag": F.lit(4), "rname": F.lit("*"), "pos": F.lit(0).cast("long"), "mapq": F.lit(0), "cigar": F.lit("*"), "rnext": F.lit("*"), "pnext": F.lit(0).cast("long"), "tlen": F.lit(0).cast("long")})


# Joins -----------------------------------------------------------------------


def tag_table(rows: DataFrame, id_column: str, columns: list[str], order: str, exclude: tuple[str, ...] = ("-", "NA")) -> DataFrame:
    """(read_id, values): the last row of an id wins; rows with a missing or excluded value are skipped."""
    ok = rows
    for c in columns:
        ok = ok.where(F.col(c).isNotNull() & ~F.col(c).isin(*exclude))
    return ok.groupBy(F.col(id_column).alias("read_id")).agg(F.max_by(F.struct(*columns), order).alias("values"))


def excluded_values(rows: DataFrame, columns: list[str], exclude: tuple[str, ...] = ("-", "NA")) -> DataFrame:
    """How often each excluded value was met."""
    return rows.select(F.explode(F.array(*columns)).alias("value")).where(F.col("value").isin(*exclude)).groupBy("value").agg(F.count("*").alias("n"))


def attach(alignments: DataFrame, table: DataFrame, names: dict[str, str]) -> DataFrame:
    """All alignments, with tags {name: column of ``values``} where their read is in the table."""
    out = alignments.join(table, alignments["qname"] == table["read_id"], "left").drop("read_id")
    for tag, c in names.items():
        out = with_tag(out, tag, F.col("values")[c])
    return out.drop("values")


def attach_sequence(alignments: DataFrame, reads: DataFrame, tag: str = "SQ") -> DataFrame:
    """The reads' sequences as a tag; alignments without a read are dropped."""
    r = reads.select(F.col("read_id").alias("_id"), F.col("seq").alias("_seq"))
    return with_tag(alignments.join(r, F.col("qname") == F.col("_id")), tag, F.col("_seq")).drop("_id", "_seq")


def only_ids(reads: DataFrame, ids: DataFrame) -> DataFrame:
    return reads.join(ids.select("read_id"), "read_id", "left_semi")


def without_ids(reads: DataFrame, ids: DataFrame) -> DataFrame:
    return reads.join(ids.select("read_id"), "read_id", "left_anti")


# Filters ----------------------------------------------------------------------


def tag_filled(df: DataFrame, tag: str) -> DataFrame:
    return df.where(value(tag).isNotNull() & (value(tag) != "-"))


def tag_present(df: DataFrame, tag: str) -> DataFrame:
    return df.where(F.map_contains_key("tags", F.lit(tag)))


def tag_empty(df: DataFrame, tag: str) -> DataFrame:
    """Only alignments whose tag is '-'; those without it are dropped too."""
    return df.where(value(tag) == "-")


def tag_at_least(df: DataFrame, tag: str, n: float) -> DataFrame:
    return df.where(value(tag).try_cast("double") >= n)


def tag_at_most(df: DataFrame, tag: str, n: float) -> DataFrame:
    return df.where((F.col("tags")[tag]["type"] == "i") & (value(tag).try_cast("double") <= n))


def mapq_below(df: DataFrame, n: int = 40) -> DataFrame:
    return df.where(F.col("mapq") < n)


def dedup_ready(df: DataFrame, tags: list[str], compat: bool = False) -> DataFrame:
    """Mapped with quality and no tag starting with '-'; ``compat`` keeps alignments that lack a tag."""
    out = df.where("mapq >= 1")
    for t in tags:
        out = out.where(F.coalesce(~value(t).startswith("-"), F.lit(compat)))
    return out


def strand(df: DataFrame, forward: bool = True) -> DataFrame:
    bit = F.col("flag").bitwiseAND(16)
    return df.where(bit == 0 if forward else bit != 0)


def unmapped(df: DataFrame) -> DataFrame:
    return df.where(F.col("flag").bitwiseAND(4) != 0)


# Order -------------------------------------------------------------------------


def version_key(name: str = "rname") -> Column:
    """Chromosome names in version order: numbers are padded, so chr2 is before chr10."""
    return F.regexp_replace(F.regexp_replace(F.col(name), r"(\d+)", "0000000000$1"), r"0+(\d{10})", "$1")


def coordinate_sort(df: DataFrame) -> DataFrame:
    return df.orderBy(version_key(), "pos")


def tag_sort(df: DataFrame, tag: str) -> DataFrame:
    """Tasks of one tag value each, sorted within: no total order is needed for grouping."""
    return df.repartition(value(tag)).sortWithinPartitions(value(tag))


def merge(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return coordinate_sort(out)
