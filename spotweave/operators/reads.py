"""Reads: orientation, splitting, barcode and UMI extraction, trimming, filters and summaries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.functions import alignment as al
from spotweave.functions import sequences as sq


def _qc_columns(compat: bool = False) -> list[Column]:
    return [
        F.length("seq").alias("Read_Length"),
        sq.gc_pct("seq").alias("GC_Percent"),
        sq.purine_pct("seq").alias("Purine_Percent"),
        sq.first_base("seq").alias("First_Base"),
        sq.last_base("seq").alias("Last_Base"),
        sq.homopolymer_max("seq").alias("Longest_Homopolymer"),
        sq.homopolymer_base("seq", compat).alias("Homopolymer_Base"),
    ]


def read_qc(reads: DataFrame, compat: bool = False) -> DataFrame:
    """Length, composition, ends and longest homopolymer of each read."""
    return reads.select(F.col("read_id").alias("Read_ID"), *_qc_columns(compat))


def alignment_qc(alignments: DataFrame, tags: list[str] = (), compat: bool = False) -> DataFrame:
    """Read QC of each alignment with flag bits and chosen tags; alignments without sequence are dropped."""
    bit = lambda n: F.getbit("flag", F.lit(n)).cast("boolean")
    return alignments.where("length(seq) > 0").select(
        F.col("qname").alias("Read_ID"),
        *_qc_columns(compat),
        bit(2).alias("is_unmapped"),
        bit(1).alias("is_proper_pair"),
        bit(8).alias("is_secondary"),
        *[F.col("tags")[t]["value"].alias(t) for t in tags],
    ).drop("Purine_Percent")


# Orientation --------------------------------------------------------------

#: Outcomes of a two-primer scan by the order of hits; (strand, start, end), lo and hi being the last start and first end of a hit, n the read length.
PAIRED = {
    "adapter1_0_f-adapter2_0_r": ("+", "hi", "lo", "full_len"),
    "adapter1_0_f": ("+", "hi", "n", "adapter1_single"),
    "adapter2_0_r": ("+", "zero", "lo", "adapter2_single"),
    "adapter2_0_f-adapter1_0_r": ("-", "hi", "lo", "full_len"),
    "adapter1_0_r": ("-", "hi", "n", "adapter1_single"),
    "adapter2_0_f": ("-", "zero", "lo", "adapter2_single"),
}
DOUBLE = {
    "adapter1_0_f-adapter1_0_r": "adapter1_double",
    "adapter1_0_r-adapter1_0_f": "adapter1_double",
    "adapter2_0_f-adapter2_0_r": "adapter2_double",
    "adapter2_0_r-adapter2_0_f": "adapter2_double",
}
SINGLE_ONE = {
    "adapter1_0_f-adapter1_0_r": ("+", "hi", "lo", "full_len"),
    "adapter1_0_r-adapter1_0_f": ("-", "hi", "lo", "full_len"),
    "adapter1_0_f": ("+", "hi", "n", "adapter1_single"),
    "adapter1_0_r": ("-", "hi", "n", "adapter1_single"),
}
SINGLE_TWO = {
    "adapter1_0_f-adapter1_1_f-adapter1_0_r": ("+", "hi", "lo", "full_len"),
    "adapter1_0_f-adapter1_1_r-adapter1_0_r": ("-", "hi", "lo", "full_len"),
    "adapter1_0_f-adapter1_1_f": ("+", "hi", "n", "adapter1_single"),
    "adapter1_0_f-adapter1_1_r": ("-", "hi", "n", "adapter1_single"),
}


def single_ended(adapter1: list[str], adapter2: list[str]) -> bool:
    """Whether a scan has one kind of primer only: none of the second, or shared ones, reverse complements included."""
    flip = str.maketrans(sq.IUPAC, sq.COMPLEMENTS)
    both = lambda xs: {*xs, *(x[::-1].translate(flip) for x in xs)}
    return not adapter2 or bool(both(adapter1) & both(adapter2))


def scan_hits(reads: DataFrame, adapter1: list[str], adapter2: list[str] = (), min_match: float = 0.7) -> DataFrame:
    """``reads`` with ``hits``: array of (start, end, name, strand, score) by start, of every adapter forward and reversed."""
    flip = str.maketrans(sq.IUPAC, sq.COMPLEMENTS)
    asked = []
    for label, adapters in (("adapter1", adapter1), ("adapter2", [] if single_ended(adapter1, adapter2) else adapter2)):
        for i, a in enumerate(adapters):
            for way, s in (("f", a), ("r", a[::-1].translate(flip))):
                strand = "+" if (label == "adapter1") == (way == "f") else "-"
                asked.append((s, f"{label}_{i}_{way}", strand))
    every = al.adapter_hits("seq", [s for s, _, _ in asked], min_match)
    hits = [
        F.struct(F.col(f"hits.start{k}").alias("start"), F.col(f"hits.end{k}").alias("end"), F.lit(name).alias("name"), F.lit(strand).alias("strand"), F.col(f"hits.score{k}").alias("score"))
        for k, (_, name, strand) in enumerate(asked)
    ]
    found = F.filter(F.array(*hits), lambda h: h["score"].isNotNull())
    return reads.withColumn("hits", every).withColumn("hits", F.array_sort(found))


def classify_orientation(scanned: DataFrame, single: bool, n_adapter1: int = 1) -> DataFrame:
    """(readlen, start, end, strand, lab, adapter_config, read_id) from ordered hits: look-ups in the outcome tables."""
    if single and n_adapter1 > 2:
        raise ValueError("a single-ended scan takes one or two primers")
    hits = F.col("hits")
    places = {
        "lo": F.array_max(F.transform(hits, lambda h: h["start"])),
        "hi": F.array_min(F.transform(hits, lambda h: h["end"])),
        "n": F.length("seq"),
        "zero": F.lit(0),
    }
    config = F.array_join(F.transform(hits, lambda h: h["name"]), "-")
    out = lambda s, a, b, lab: F.struct(F.lit(s).alias("strand") if isinstance(s, str) else s.alias("strand"), places[a].alias("start"), places[b].alias("end"), F.lit(lab).alias("lab"))

    def chosen(table: dict, otherwise: Column) -> Column:
        for key, result in reversed(table.items()):
            otherwise = F.when(config == key, out(*result)).otherwise(otherwise)
        return otherwise

    if single:
        verdict = chosen(SINGLE_ONE if n_adapter1 == 1 else SINGLE_TWO, out("+", "hi", "n", "other"))
    else:
        of = lambda s: F.aggregate(F.filter(hits, lambda h: h["strand"] == s), F.lit(0), lambda acc, h: acc + h["score"])
        sums = {s: of(s) for s in "+-"}
        plus, minus = F.exists(hits, lambda h: h["strand"] == "+"), F.exists(hits, lambda h: h["strand"] == "-")
        by_score = F.when(sums["+"] > 1.1 * sums["-"], "+").when(sums["-"] > 1.1 * sums["+"], "-").otherwise("=")
        mixed = chosen({k: (by_score, "hi", "lo", lab) for k, lab in DOUBLE.items()}, out(by_score, "zero", "n", "other_ambiguous"))
        one_sided = chosen(PAIRED, F.when(plus, out("+", "zero", "n", "other")).otherwise(out("-", "zero", "n", "other")))
        verdict = F.when(plus & minus, mixed).otherwise(one_sided)
    verdict = F.when(F.size(hits) == 0, out("=", "zero", "n", "no_adapters")).otherwise(verdict)
    return scanned.withColumn("v", verdict).select(
        F.length("seq").alias("readlen"), "v.start", "v.end", "v.strand", "v.lab", F.when(F.size(hits) == 0, "ambiguous").otherwise(config).alias("adapter_config"), "read_id"
    )


def adapter_scan(reads: DataFrame, adapter1: list[str], adapter2: list[str] = (), min_match: float = 0.7) -> DataFrame:
    return classify_orientation(scan_hits(reads, adapter1, adapter2, min_match), single_ended(adapter1, adapter2), len(adapter1))


def stranded_reads(reads: DataFrame, scan: DataFrame) -> DataFrame:
    """Reads turned to the forward strand."""
    minus = F.col("strand") == "-"
    return reads.join(scan.select("read_id", "strand"), "read_id").select(
        "read_id", F.when(minus, sq.revcomp("seq")).otherwise(F.col("seq")).alias("seq"), F.when(minus, F.reverse("qual")).otherwise(F.col("qual")).alias("qual")
    )


def scan_summary(scan: DataFrame) -> DataFrame:
    """By label: count and mean, median, least and greatest read length, half-even to 2 places."""
    two = lambda c: F.bround(c.cast("double"), 2)
    n = F.col("readlen")
    return scan.groupBy("lab").agg(
        F.count("*").alias("n"), two(F.avg(n)).alias("mean"), two(F.median(n)).alias("median"), two(F.min(n)).alias("min"), two(F.max(n)).alias("max")
    )


def scan_positions(scan: DataFrame) -> DataFrame:
    """readlength = end + start, and start over it (NULL for 0)."""
    return scan.withColumn("readlength", F.col("end") + F.col("start")).withColumn("normStart", F.try_divide("start", "readlength"))


def within_3sd(df: DataFrame, value: str) -> DataFrame:
    """Rows within three sample standard deviations of the mean, inclusive; one row of statistics is broadcast."""
    stats = df.agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    return df.join(F.broadcast(stats)).where(F.abs(F.col(value) - F.col("_m")) <= 3 * F.col("_s")).drop("_m", "_s")


def full_length(scan: DataFrame) -> DataFrame:
    return scan.where("lab = 'full_len'")


# Splitting and extraction ---------------------------------------------------


def split_reads(reads: DataFrame, anchor: str, split: str, offset: int = 8, min_length: int = 12, min_match: float = 0.7) -> DataFrame:
    """(read_id, status, r1, r2): cut after ``split``; r2 is the reversed rest.  The whole read is searched, whatever the offset."""
    a, s = al.adapter_hit("seq", anchor, min_match), al.adapter_hit("seq", split, min_match)
    at = F.col("s.end") + offset
    first = lambda c: F.substring(F.col(c), F.lit(1), at)
    rest = lambda c: F.substring(F.col(c), at + 1, F.length(c))
    long = (F.length(first("seq")) > min_length) & (F.length(rest("seq")) > min_length)
    status = F.when(F.col("a.score").isNull(), "no_anchor").when(F.col("s.score").isNull(), "no_split").when(long, "written").otherwise("too_short")
    out = reads.withColumn("a", a).withColumn("s", s).withColumn("status", status)
    done = F.col("status") == "written"
    return out.select(
        "read_id", "status",
        F.when(done, F.struct(first("seq").alias("seq"), first("qual").alias("qual"))).alias("r1"),
        F.when(done, F.struct(sq.revcomp(rest("seq"), iupac=False).alias("seq"), F.reverse(rest("qual")).alias("qual"))).alias("r2"),
    )


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("status").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Element:
    """A barcode or UMI beside an anchor: a sequence, or a position (then the offset is void)."""

    anchor: str | int
    length: int
    offset: int = 0
    side: str = "right"
    min_match: float = 0.7

    def value(self, seq: Column, compat: bool = False) -> Column:
        fixed = isinstance(self.anchor, int) or str(self.anchor).isdigit()
        hit = al.positional_hit(int(self.anchor)) if fixed else al.adapter_hit(seq, str(self.anchor), self.min_match)
        offset = 0 if fixed else self.offset
        if self.side == "left":
            stop = hit["start"] - offset
            start = stop - self.length
        else:
            start = hit["end"] + offset
            stop = start + self.length
        got = sq.py_slice(seq, start, stop, wrap=compat)
        short = F.lit(False) if fixed else F.length(seq) < len(str(self.anchor))
        return F.when(~short & (F.length(got) == self.length), got)


def call_barcodes(reads: DataFrame, barcodes: list[Element], umis: list[Element] = (), compat: bool = False, keep: list[str] = ()) -> DataFrame:
    """(read_id, *keep, bcs, umis): arrays with NULL for what isn't found, for every read; ``keep`` names columns to carry along."""
    seq = F.col("seq")
    return reads.select(
        "read_id",
        *keep,
        F.array(*[e.value(seq, compat) for e in barcodes]).alias("bcs"),
        (F.array(*[e.value(seq, compat) for e in umis]) if umis else F.expr("cast(array() as array<string>)")).alias("umis"),
    )


def complete_calls(calls: DataFrame) -> DataFrame:
    """Calls whose every barcode was found; UMIs may be missing."""
    return calls.where(~F.exists("bcs", F.isnull))


def drop_missing_calls(calls: DataFrame) -> DataFrame:
    """Calls without any missing barcode or UMI."""
    return complete_calls(calls).where(~F.exists("umis", F.isnull))


def call_stats(calls: DataFrame) -> DataFrame:
    """Seven counters; UMIs are only judged for reads with all barcodes."""
    lost = lambda c: F.size(F.filter(c, F.isnull))
    all_bc = lost("bcs") == 0
    count = lambda c: F.count_if(c)
    return calls.agg(
        F.count("*").alias("total_reads"),
        count(all_bc).alias("bc_match_count"),
        count((lost("bcs") > 0) & (lost("bcs") < F.size("bcs"))).alias("bc_missing_count"),
        count((lost("bcs") == F.size("bcs")) & (F.size("bcs") > 0)).alias("no_bc_count"),
        count(all_bc & (lost("umis") == 0)).alias("umi_match_count"),
        count(all_bc & (lost("umis") > 0) & (lost("umis") < F.size("umis"))).alias("umi_missing_count"),
        count(all_bc & (lost("umis") == F.size("umis")) & (F.size("umis") > 0)).alias("no_umi_count"),
    )


# Trimming -------------------------------------------------------------------


def internal_trim(reads: DataFrame, adapters: list[str], least: int = 58, barcode: int = 8) -> DataFrame:
    """(read_id, seq, qual, status): an internal adapter is cut out and the first barcode kept at its length."""
    h = F.col("h")
    hit = reads.withColumn("h", al.internal_hit("seq", adapters, least))
    pad = barcode - h["start"]

    def cut(c: str, filler: str) -> Column:
        s = F.col(c)
        rest = F.substring(s, h["end"] + 1, F.length(s))
        kept = sq.py_slice(s, h["start"], F.lit(barcode), wrap=True)
        return (
            F.when(h["score"].isNull(), filler)
            .when(h["start"] < barcode, F.concat(F.repeat(F.lit(filler), pad), kept, rest))
            .otherwise(F.concat(F.substring(s, 1, barcode), rest))
        )

    status = F.when(h["score"].isNull(), "missing").when(h["start"] < barcode, "deletion").when(h["start"] > barcode, "insertion").otherwise("exact")
    return hit.select("read_id", cut("seq", "N").alias("seq"), cut("qual", "!").alias("qual"), status.alias("status"))


def trim_stats(trimmed: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s)
    return trimmed.agg(F.count("*").alias("reads"), count("insertion").alias("insertions"), count("deletion").alias("deletions"), count("missing").alias("missing"))


def quality_cut(quality: np.ndarray, cutoff: int) -> int:
    """Bases to keep: the running sum of cutoff - q from the 3' end is greatest at the cut; it stops when negative."""
    total = best = 0
    keep = len(quality)
    for i in range(len(quality) - 1, -1, -1):
        total += cutoff - int(quality[i])
        if total < 0:
            break
        if total > best:
            best, keep = total, i
    return keep


def adapter_cut(seq: str, adapter: str, error: float, overlap: int) -> int:
    """Where the leftmost best 3' adapter begins (substitutions only, partial at the end), or the length."""
    s, a = np.frombuffer(seq.encode(), np.uint8), np.frombuffer(adapter.encode(), np.uint8)
    best = (0, len(s))
    for i in range(len(s)):
        n = min(len(a), len(s) - i)
        if n < overlap:
            break
        wrong = int((s[i : i + n] != a[:n]).sum())
        if wrong <= int(error * n) and n - wrong > best[0]:
            best = (n - wrong, i)
    return best[1]


def trim_adapters(reads: DataFrame, adapters: list[str], quality: int = 20, error: float = 0.1, overlap: int = 5, trim_n: bool = True) -> DataFrame:
    """A documented subset of adapter trimming: 3' quality, 3' adapters one after another, then N at both ends."""

    @F.pandas_udf("seq string, qual string")
    def trim(seqs: pd.Series, quals: pd.Series) -> pd.DataFrame:
        out = []
        for s, q in zip(seqs.fillna(""), quals.fillna(""), strict=True):
            keep = quality_cut(np.frombuffer(q.encode(), np.uint8).astype(int) - 33, quality)
            for a in adapters:
                keep = min(keep, adapter_cut(s[:keep], a, error, overlap))
            s, q = s[:keep], q[:keep]
            if trim_n:
                left = len(s) - len(s.lstrip("N"))
                right = len(s.rstrip("N"))
                s, q = s[left:right], q[left:right]
            out.append((s, q))
        return pd.DataFrame(out, columns=["seq", "qual"])

    return reads.withColumn("t", trim("seq", "qual")).withColumns({"seq": F.col("t.seq"), "qual": F.col("t.qual")}).drop("t")


# Filters and summaries ------------------------------------------------------


def longer_than(reads: DataFrame, n: int) -> DataFrame:
    return reads.where(F.length("seq") > n)


def shorter_than(reads: DataFrame, n: int) -> DataFrame:
    return reads.where(F.length("seq") < n)


def at_least(reads: DataFrame, n: int) -> DataFrame:
    return reads.where(F.length("seq") >= n)


def mismatched_quality(reads: DataFrame) -> DataFrame:
    return reads.where(F.length("seq") != F.length("qual"))


def pair_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """(read_id, r1, r2) of mates by id."""
    pack = lambda df, n: df.select("read_id", F.struct("seq", "qual").alias(n))
    return pack(r1, "r1").join(pack(r2, "r2"), "read_id")


def long_pairs(pairs: DataFrame, r1: int, r2: int = 12) -> DataFrame:
    """Pairs of which neither mate is too short."""
    return pairs.where((F.length("r1.seq") >= r1) & (F.length("r2.seq") >= r2))


def length_stats(df: DataFrame, text: str) -> DataFrame:
    """Mean length, its integer part, and the population standard deviation."""
    n = F.length(text)
    return df.agg(F.avg(n).alias("mean_len"), F.avg(n).cast("long").alias("mean_len_int"), F.stddev_pop(n).alias("sd_len"))


def histogram(df: DataFrame, value, width: float, by: list[str] = ()) -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*by, (F.floor(v / width) * width).alias("bin")).agg(F.count("*").alias("n"))


def downsample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly n rows, the same in every run: smallest hash of the key first."""
    return df.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(n)


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)
