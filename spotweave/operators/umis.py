"""UMI counting and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.graphs import components
from spotweave.operators.quantify import one_mismatch
from spotweave.sources.scratch import written


def count_exact(reads: DataFrame, keys: list[str] = ("cell", "gene"), umi: str = "umi") -> DataFrame:
    """Distinct UMIs of each group: distinct first, so a hot group is combined before the shuffle."""
    return reads.select(*keys, umi).where(F.col(umi).isNotNull()).distinct().groupBy(*keys).agg(F.count("*").alias("n"))


def count_directional(reads: DataFrame, keys: list[str] = ("cell", "gene"), umi: str = "umi") -> DataFrame:
    """Clusters of UMIs of each group: from the most counted on, a UMI takes in those that differ from it in one base and have n(u) >= 2 n(v) - 1, and what they take in.

    No group is brought together.  Reads are counted per UMI first, and pairs
    that differ in one base are found by an equi-join on UMIs with one base hidden.  A UMI of
    more than one read can only be taken in by one with more reads, so it
    leads a cluster if no such pair says otherwise.  UMIs of one read can take each other
    in: a connected component of them has one leader, unless a UMI of more reads takes one of its members in.
    """
    keys = list(keys)
    counted = written(reads.where(F.col(umi).isNotNull()).groupBy(*keys, F.col(umi).alias("u")).agg(F.count("*").alias("c")), "umis")
    # NULLs in the keys are one group.
    key = F.struct(*[F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("k")) for k in keys])
    key = F.to_json(key)
    own = counted.select(F.sha2(key, 256).alias("g"), "u", "c")
    pairs = one_mismatch(own, own.select("g", F.col("u").alias("v")), "u", "v", ["g"])
    pairs = pairs.join(own, ["g", "u"]).join(own.select("g", F.col("u").alias("v"), F.col("c").alias("d")), ["g", "v"])
    taking = written(pairs.where(F.col("c") >= 2 * F.col("d") - 1).select("g", "u", "v", "c", "d"), "pairs")
    taken = taking.where("c > 1").select("g", F.col("v").alias("u")).distinct()
    single = taking.where("c = 1 and d = 1").select(F.struct("g", "u").alias("u"), F.struct("g", F.col("v").alias("v")).alias("v"))
    lead = own.join(taken, ["g", "u"], "left_anti")
    if not single.isEmpty():
        member = components(single.select("u", F.struct(F.col("v.g").alias("g"), F.col("v.v").alias("u")).alias("v")))
        member = member.select(F.col("node.g").alias("g"), F.col("node.u").alias("u"), F.col("component.u").alias("first"))
        # Of a component nobody leads where a member was taken in, else its first member does.
        lost = member.join(taken, ["g", "u"], "left_semi").select("g", "first").distinct()
        followers = member.where("u <> first").select("g", "u").union(member.join(lost, ["g", "first"], "left_semi").select("g", "u"))
        lead = lead.join(followers.distinct(), ["g", "u"], "left_anti")
    per = lead.groupBy("g").agg(F.count("*").alias("n"))
    groups = counted.select(*keys).distinct().withColumn("g", F.sha2(key, 256))
    return groups.join(per, "g").select(*keys, "n")


def five_prime_position(compat: bool = False) -> tuple[Column, Column]:
    """(unclipped 5' position, whether reversed) of an alignment: clipped bases count as if they were aligned.

    With ``compat`` clips are left out, so alignments of one molecule that are clipped differently stay apart.
    """
    reverse = F.col("flag").bitwiseAND(16) != 0
    covered = F.expr("aggregate(regexp_extract_all(cigar, '(\\\\d+)[MDN=X]', 1), 0L, (a, x) -> a + cast(x as long))")
    clip = lambda pattern: F.coalesce(F.expr(f"try_cast(regexp_extract(cigar, '{pattern}', 1) as long)"), F.lit(0)) if not compat else F.lit(0)
    head, tail = clip("^(?:\\\\d+H)?(\\\\d+)S"), clip("(\\\\d+)S(?:\\\\d+H)?$")
    return F.when(reverse, F.col("pos") + covered + tail).otherwise(F.col("pos") - head), reverse


def _best(alignments: DataFrame, keys: list[Column]) -> DataFrame:
    """One row of each group: the best mapping quality, then the least name."""
    row = F.struct(*alignments.columns)
    return alignments.groupBy(*keys).agg(F.min_by(row, F.struct(-F.col("mapq"), "qname")).alias("_r")).select("_r.*")


def dedup_positions(alignments: DataFrame, cell: str = "CB", umi: str = "UB", compat: bool = False) -> DataFrame:
    """One alignment for each (chromosome, 5' position, strand, cell, UMI): the best mapping quality, then the least name."""
    five, reverse = five_prime_position(compat)
    return _best(alignments, ["rname", five.alias("_five"), reverse.alias("_rev"), F.col("tags")[cell]["value"].alias("_cell"), F.col("tags")[umi]["value"].alias("_umi")])


def dedup_by_tag(alignments: DataFrame, tag: str = "XB") -> DataFrame:
    """One alignment for each (transcript, combined tag): the best mapping quality, then the least name."""
    return _best(alignments, ["rname", F.col("tags")[tag]["value"].alias("_t")])
