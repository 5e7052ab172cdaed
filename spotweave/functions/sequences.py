"""Native sequence functions: every one returns a Column and stays in code generation."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The IUPAC alphabet and its complements, in both cases.
IUPAC = "ACGTWSMKRYBDHVNacgtwsmkrybdhvn"
COMPLEMENTS = "TGCAWSKMYRVHDBNtgcawskmyrvhdbn"
ANSI = r"\x1B\[[0-9;]*[mK]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def revcomp(seq, iupac: bool = True) -> Column:
    """Reverse complement; without ``iupac`` only upper-case ACTG are complemented."""
    s = F.reverse(col(seq))
    return F.translate(s, IUPAC, COMPLEMENTS) if iupac else F.translate(s, "ACTG", "TGAC")


def py_slice(seq, start, stop, wrap: bool = False) -> Column:
    """seq[start:stop]; a negative bound gives NULL, or with ``wrap`` counts from the end."""
    s, a, b = col(seq), col(start), col(stop)
    n = F.length(s)
    if wrap:
        a = F.when(a < 0, F.greatest(a + n, F.lit(0))).otherwise(a)
        b = F.when(b < 0, F.greatest(b + n, F.lit(0))).otherwise(b)
        return F.substring(s, a + 1, F.greatest(b - a, F.lit(0)))
    return F.when((a >= 0) & (b >= 0), F.substring(s, a + 1, F.greatest(b - a, F.lit(0))))


def hard_trim(seq, keep: int, start: int, length: int) -> Column:
    """The first ``keep`` bases and ``length`` bases from the 1-based ``start``."""
    return F.concat(F.substring(col(seq), 1, keep), F.substring(col(seq), start, length))


def trim_ends(seq, left: int = 0, right: int = 0) -> Column:
    s = col(seq)
    return F.substring(s, F.lit(left + 1), F.greatest(F.length(s) - left - right, F.lit(0)))


def clip(seq, most: int) -> Column:
    return F.substring(col(seq), 1, most)


def share_pct(seq, bases: str) -> Column:
    """Per cent of ``bases``, upper case only, half-even to 2 places; NULL for an empty read."""
    s = col(seq)
    hits = F.length(s) - F.length(F.translate(s, bases, ""))
    return F.when(F.length(s) > 0, F.bround(100.0 * hits / F.length(s), 2))


def gc_pct(seq) -> Column:
    return share_pct(seq, "GC")


def purine_pct(seq) -> Column:
    return share_pct(seq, "GA")


def first_base(seq) -> Column:
    return F.when(F.length(col(seq)) > 0, F.substring(col(seq), 1, 1))


def last_base(seq) -> Column:
    return F.when(F.length(col(seq)) > 0, F.right(col(seq), F.lit(1)))


def _runs(seq) -> Column:
    return F.regexp_extract_all(col(seq), F.lit(r"((.)\2*)"), 1)


def homopolymer_max(seq) -> Column:
    return F.array_max(F.transform(_runs(seq), F.length))


def homopolymer_base(seq, compat: bool = False) -> Column:
    """Base of the first longest run; ``compat`` takes the base at the run's number in the sequence instead."""
    lens = F.transform(_runs(seq), F.length)
    nth = F.array_position(lens, F.array_max(lens)).cast("int")
    if compat:
        return F.when(nth > 0, F.substring(col(seq), nth, F.lit(1)))
    return F.when(nth > 0, F.substring(F.element_at(_runs(seq), nth), 1, 1))


def kmers(seq, k: int) -> Column:
    """All k-mers in order; a sequence shorter than k is an error."""
    s = col(seq)
    some = F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: F.substring(s, i, F.lit(k)))
    return F.when(F.length(s) >= k, some).otherwise(F.raise_error(F.lit(f"sequence shorter than k={k}")))


def split_barcode(seq, at: int) -> Column:
    """(part1, part2, joined by '_'): the second part is the whole remainder."""
    s = col(seq)
    a, b = F.substring(s, 1, at), F.substring(s, F.lit(at + 1), F.length(s))
    return F.struct(a.alias("part1"), b.alias("part2"), F.concat_ws("_", a, b).alias("joined"))


def insert_adapter(part1, part2, adapter: str, primer: str = "") -> Column:
    return F.concat(F.lit(primer), col(part1), F.lit(adapter), col(part2))


def strip_ansi(text) -> Column:
    return F.regexp_replace(col(text), ANSI, "")


def report_number(value) -> Column:
    """Report values as numbers where they are: parentheses, per cent signs and thousands commas go."""
    v = F.regexp_replace(F.regexp_replace(col(value), r"\(.*?\)", ""), "[%,]", "")
    return F.trim(v)


def strip_suffix(barcode) -> Column:
    """The first '-1' and every '_' go."""
    return F.regexp_replace(F.regexp_replace(col(barcode), "^(.*?)-1", "$1"), "_", "")


def pipes_to_columns(feature) -> Column:
    return F.split(col(feature), r"\|")


def five_prime(start, end, strand) -> tuple[Column, Column]:
    """The single-base interval at the 5' end."""
    minus = col(strand) == "-"
    s = F.when(minus, col(end) - 1).otherwise(col(start))
    return s, s + 1


def register_sql(spark: SparkSession) -> None:
    """The functions for SQL text, as temporary SQL functions."""
    bodies = {
        "revcomp(s STRING)": ("STRING", f"translate(reverse(s), '{IUPAC}', '{COMPLEMENTS}')"),
        "gc_pct(s STRING)": ("DOUBLE", "if(length(s) > 0, bround(100.0D * (length(s) - length(translate(s, 'GC', ''))) / length(s), 2), NULL)"),
        "kmers(s STRING, k INT)": ("ARRAY<STRING>", "transform(sequence(1, length(s) - k + 1), i -> substr(s, i, k))"),
        "homopolymer_max(s STRING)": ("INT", r"array_max(transform(regexp_extract_all(s, '((.)\\2*)', 1), x -> length(x)))"),
        "py_slice(s STRING, a INT, b INT)": ("STRING", "if(a >= 0 and b >= 0, substr(s, a + 1, greatest(b - a, 0)), NULL)"),
    }
    for head, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
