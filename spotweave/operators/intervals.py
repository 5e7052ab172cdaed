"""Interval algebra: overlaps by bins, merging, coverage, spliced blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the bins that turn an overlap into an equi-join.
BIN = 10_000
#: Positions of a block that one task orders.
BLOCK = 1 << 20


def _binned(df: DataFrame, width: int, slack: int = 0) -> DataFrame:
    lo, hi = F.floor((F.col("start") - slack) / width), F.floor((F.greatest(F.col("end") - 1, F.col("start")) + slack) / width)
    return df.withColumn("_bin", F.explode(F.sequence(lo, hi)))


def overlaps(left: DataFrame, right: DataFrame, stranded: bool = False, width: int = BIN, slack: int = 0) -> DataFrame:
    """Pairs (l, r structs) of half-open intervals that overlap, or lie within ``slack``, on a chromosome.

    A pair is made only in the first bin both share, so nothing has to be made
    distinct.  A crowded bin is left to adaptive skew joins; a smaller ``width``
    makes bins finer.
    """
    a = _binned(left.select(F.struct(*left.columns).alias("l"), "chrom", "start", "end", *(["strand"] if stranded else [])), width, slack)
    b = _binned(right.select(F.struct(*right.columns).alias("r"), "chrom", "start", "end", *(["strand"] if stranded else [])), width)
    a, b = a.alias("a"), b.alias("b")
    on = (F.col("a.chrom") == F.col("b.chrom")) & (F.col("a._bin") == F.col("b._bin"))
    if stranded:
        on &= F.col("a.strand") == F.col("b.strand")
    near = (F.col("a.start") - slack < F.col("b.end")) & (F.col("b.start") < F.col("a.end") + slack)
    first = F.col("a._bin") == F.greatest(F.floor((F.col("a.start") - slack) / width), F.floor(F.col("b.start") / width))
    return a.join(b, on & near & first).select("l", "r")


def overlap_length() -> Column:
    return F.least("l.end", "r.end") - F.greatest("l.start", "r.start")


def not_overlapping(left: DataFrame, right: DataFrame, key: str = "name", width: int = BIN) -> DataFrame:
    """Intervals of ``left`` that overlap none of ``right``, whatever the strand."""
    hit = overlaps(left, right, width=width).select(F.col(f"l.{key}").alias(key)).distinct()
    return left.join(hit, key, "left_anti")


def coverage(targets: DataFrame, blocks: DataFrame, stranded: bool = True, block: int = BLOCK) -> DataFrame:
    """``targets`` with ``n``, the number of overlapping blocks, 0 included.

    No pair is made: what overlaps [start, end) are the blocks that start
    before its end, less those that end by its start (empty blocks are counted
    by themselves, inside of it).  These are running counts over positions,
    which are cut into blocks of positions, each ordered by a task of its own,
    with the counts of earlier ones from one row a block.
    """
    by = ["chrom", "strand"] if stranded else ["chrom"]
    counts = ["_starts", "_ends", "_empty"]
    none = F.lit(0).cast("long")
    known = blocks.where(" and ".join(f"{c} is not null" for c in by))
    full, empty = known.where("start < end"), known.where("start >= end")

    def points(rows: DataFrame, at: str, kind: str) -> DataFrame:
        n = rows.groupBy(*by, F.col(at).alias("_at")).agg(F.count("*").alias("_n"))
        return n.select(*by, "_at", F.lit(1).alias("_turn"), *[(F.col("_n") if c == kind else none).alias(c) for c in counts], none.alias("_lo"), none.alias("_hi"))

    def asked(at: str, turn: int) -> DataFrame:
        rows = targets.select(*by, "start", "end").distinct()
        return rows.select(*by, F.col(at).alias("_at"), F.lit(turn).alias("_turn"), *[none.alias(c) for c in counts], F.col("start").alias("_lo"), F.col("end").alias("_hi"))

    # Of equal positions: the end of a target, then starts and ends of blocks, then the start of a target.
    line = points(full, "start", "_starts").unionByName(points(full, "end", "_ends")).unionByName(points(empty, "start", "_empty")).unionByName(asked("end", 0)).unionByName(asked("start", 2))
    line = line.withColumn("_block", F.floor(F.col("_at") / block))
    before, _ = _carried(line, by)
    sums = line.groupBy(*by, "_block").agg(*[F.sum(c).alias(f"{c}_in") for c in counts])
    sums = sums.select(*by, "_block", *[F.coalesce(F.sum(f"{c}_in").over(before), none).alias(f"{c}_in") for c in counts])
    w = Window.partitionBy(*by, "_block").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    run = _with_blocks(line, sums, by).select(*by, "_turn", "_lo", "_hi", *[(F.col(f"{c}_in") + F.sum(c).over(w)).alias(c) for c in counts])
    at = lambda turn, c: F.sum(F.when(F.col("_turn") == turn, F.col(c)))
    n = at(0, "_starts") - at(2, "_ends") + F.greatest(at(0, "_empty") - at(2, "_empty"), none)
    n = run.where("_turn <> 1").groupBy(*by, "_lo", "_hi").agg(n.alias("_n"))
    t, c = targets.alias("t"), n.alias("c")
    on = (F.col("t.start") == F.col("c._lo")) & (F.col("t.end") == F.col("c._hi"))
    for k in by:
        on &= F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}"))
    return t.join(c, on, "left").select("t.*", F.coalesce("c._n", none).alias("n"))


def at_least(covered: DataFrame, n: int = 5) -> DataFrame:
    return covered.where(F.col("n") >= n)


def large_chromosomes(df: DataFrame, rows: int) -> DataFrame:
    """Chromosomes with at least so many rows (in place of a size of files)."""
    keep = df.groupBy("chrom").agg(F.count("*").alias("_n")).where(F.col("_n") >= rows).select("chrom")
    return df.join(keep, "chrom", "left_semi")


def _carried(blocks: DataFrame, by: list[str], bin_: str = "_block") -> tuple:
    """Windows over the few blocks of a group: those before one, and those after it."""
    w = Window.partitionBy(*by).orderBy(bin_)
    return w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)


def merge_intervals(df: DataFrame, gap: int = 0, block: int = BLOCK) -> DataFrame:
    """(chrom, strand, start, end, n): intervals of a strand merged when at most ``gap`` apart.

    Intervals that start together are combined first, before any shuffle of
    rows, so a block holds as many rows as it has positions at most.  A strand
    is cut into blocks of starts, each ordered by a task of its own; how far
    earlier blocks reach, and the last interval opened in them, come from one
    row a block.
    """
    by = ["chrom", "strand"]
    together = df.groupBy(*by, "start").agg(F.max("end").alias("end"), F.count("*").alias("n"))
    cut = together.withColumn("_block", F.floor(F.col("start") / block))
    before, _ = _carried(cut, by)
    reaches = cut.groupBy(*by, "_block").agg(F.max("end").alias("_end")).withColumn("_in", F.max("_end").over(before)).drop("_end")
    w = Window.partitionBy(*by, "_block").orderBy("start", "end")
    # One join tells each row how far the blocks before its own reach.
    rows = _with_blocks(cut, reaches, by)
    reach = F.greatest(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), "_in")
    opened = rows.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach + gap), 1).otherwise(0))
    numbered = opened.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = numbered.groupBy(*by, "_block", "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    # A part without a start of its own (_g = 0) goes on with the last one opened in an earlier block.
    every = parts.groupBy(*by, "_block").agg(F.max(F.when(F.col("_g") > 0, F.col("_g"))).alias("_last"))
    owner = F.last(F.when(F.col("_last").isNotNull(), F.struct(F.col("_block").alias("b"), F.col("_last").alias("g"))), True).over(before)
    every = every.withColumn("_owner", owner).drop("_last")
    own = F.when(F.col("_g") > 0, F.struct(F.col("_block").alias("b"), F.col("_g").alias("g"))).otherwise(F.col("_owner"))
    owned = _with_blocks(parts, every, by).withColumn("_own", own)
    return owned.groupBy(*by, "_own").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("_own")


def _with_blocks(rows: DataFrame, blocks: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with the columns of their block; NULLs in ``by`` are equal."""
    key = [*by, "_block"]
    named = blocks.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(key)})
    on = None
    for i, c in enumerate(key):
        same = F.col(c).eqNullSafe(F.col(f"_k{i}"))
        on = same if on is None else on & same
    return rows.join(named, on).drop(*[f"_k{i}" for i in range(len(key))])


def genome_coverage(df: DataFrame, by: tuple[str, ...] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Runs (start, end, depth) of equal depth above 0: +1 at starts, -1 at ends, summed before the window.

    Positions are cut into blocks, each ordered by a task of its own; the depth
    before a block and the next position after it come from one row a block.
    """
    by = list(by)
    events = df.select(*by, F.col("start").alias("at"), F.lit(1).alias("d")).union(df.select(*by, F.col("end").alias("at"), F.lit(-1).alias("d")))
    steps = events.groupBy(*by, "at").agg(F.sum("d").alias("d")).where("d <> 0").withColumn("_block", F.floor(F.col("at") / block))
    before, after = _carried(steps, by)
    blocks = steps.groupBy(*by, "_block").agg(F.sum("d").alias("_sum"), F.min("at").alias("_min"))
    blocks = blocks.select(*by, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_in"), F.min("_min").over(after).alias("_next"))
    w = Window.partitionBy(*by, "_block").orderBy("at")
    runs = _with_blocks(steps, blocks, by).select(
        *by, F.col("at").alias("start"), F.coalesce(F.lead("at").over(w), "_next").alias("end"), (F.sum("d").over(w) + F.col("_in")).cast("long").alias("depth")
    )
    return runs.where("depth > 0 and end is not null")


def signed_track(cov: DataFrame, strand: str, log: bool = False) -> DataFrame:
    """bedGraph values: minus strands negated, or logarithms."""
    v = F.log10("depth") if log else F.col("depth").cast("double")
    return cov.withColumn("value", -v if strand == "-" else v)


def with_blocks(alignments: DataFrame) -> DataFrame:
    """Alignments with ``blocks``, an array of 0-based half-open (start, end): N cuts blocks, M, =, X and D extend them."""
    step = """aggregate(
        arrays_zip(transform(regexp_extract_all(cigar, '(\\\\d+)([MIDNSHP=X])', 1), x -> cast(x as long)), regexp_extract_all(cigar, '(\\\\d+)([MIDNSHP=X])', 2)),
        named_struct('at', cast(pos as bigint) - 1, 'from', cast(pos as bigint) - 1, 'out', cast(array() as array<struct<start:bigint,end:bigint>>)),
        (acc, op) -> case
            when op['1'] in ('M', '=', 'X', 'D') then named_struct('at', acc.at + op['0'], 'from', acc.from, 'out', acc.out)
            when op['1'] = 'N' then named_struct('at', acc.at + op['0'], 'from', acc.at + op['0'],
                'out', if(acc.at > acc.from, concat(acc.out, array(named_struct('start', acc.from, 'end', acc.at))), acc.out))
            else acc end,
        acc -> if(acc.at > acc.from, concat(acc.out, array(named_struct('start', acc.from, 'end', acc.at))), acc.out))"""
    return alignments.where("cigar <> '*'").withColumn("blocks", F.expr(step))


def _placed(alignments: DataFrame) -> list[Column]:
    return [F.col("rname").alias("chrom"), F.col("qname").alias("name"), F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+").alias("strand")]


def cigar_blocks(alignments: DataFrame) -> DataFrame:
    """One row a block of a spliced alignment, 0-based half-open."""
    chrom, name, strand = _placed(alignments)
    return with_blocks(alignments).withColumn("b", F.explode("blocks")).select(chrom, "b.start", "b.end", name, F.col("mapq").cast("string").alias("score"), strand)


def spans(alignments: DataFrame) -> DataFrame:
    """(name, chrom, strand, start, end, blocks): one row an alignment that covers anything."""
    chrom, name, strand = _placed(alignments)
    found = with_blocks(alignments).where("size(blocks) > 0")
    return found.select(name, chrom, strand, F.get("blocks", F.lit(0))["start"].alias("start"), F.try_element_at("blocks", F.lit(-1))["end"].alias("end"), "blocks")


def assign_features(blocks: DataFrame, features: DataFrame, feature: str = "gene", stranded: bool = True, largest: bool = False, min_length: int = 10, max_length: int = 10_000, width: int = BIN) -> DataFrame:
    """(read_id, status, n_targets, targets): reads by overlap; several features are ambiguous, or with ``largest`` the largest overlap wins, of equal ones the least name."""
    sized = blocks.groupBy("name").agg(F.sum(F.col("end") - F.col("start")).alias("len")).where(F.col("len").between(min_length, max_length)).select("name")
    pairs = overlaps(blocks.join(sized, "name", "left_semi"), features, stranded, width)
    per = pairs.groupBy(F.col("l.name").alias("read_id"), F.col(f"r.{feature}").alias("target")).agg(F.sum(overlap_length()).alias("bases"))
    if largest:
        best = per.groupBy("read_id").agg(F.min_by("target", F.struct(-F.col("bases"), "target")).alias("targets")).withColumn("n_targets", F.lit(1).cast("long"))
        found = best.withColumn("status", F.lit("Assigned"))
    else:
        found = per.groupBy("read_id").agg(F.count("*").alias("n_targets"), F.min("target").alias("t"))
        found = found.select("read_id", "n_targets", F.when(F.col("n_targets") == 1, F.col("t")).alias("targets"), F.when(F.col("n_targets") == 1, "Assigned").otherwise("Unassigned_Ambiguity").alias("status"))
    every = blocks.select(F.col("name").alias("read_id")).distinct()
    return every.join(found, "read_id", "left").select("read_id", F.coalesce("status", F.lit("Unassigned_NoFeatures")).alias("status"), F.coalesce("n_targets", F.lit(0)).cast("long").alias("n_targets"), "targets")


def active_regions(raw: DataFrame, blocks: DataFrame, annotation: DataFrame, gap: int = 500, least: int = 5, width: int = BIN) -> DataFrame:
    """Unannotated transcribed regions: merged, covered, filtered, annotated ones dropped, named."""
    merged = merge_intervals(raw, gap).withColumn("name", F.concat_ws("_", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand")).drop("n")
    return not_overlapping(at_least(coverage(merged, blocks), least), annotation, width=width)


def region_counts(blocks: DataFrame, regions: DataFrame, cells: DataFrame, width: int = BIN, **options) -> DataFrame:
    """(cell, gene, n): distinct UMIs of each cell in each region, from blocks by read name and (name, cell, umi) of the reads.

    Reads of more than one region, or of none, count for no region.
    """
    from spotweave.operators.umis import count_exact

    found = assign_features(blocks, regions.withColumnRenamed("name", "gene"), width=width, **options).where("status = 'Assigned'")
    return count_exact(found.select(F.col("read_id").alias("name"), F.col("targets").alias("gene")).join(cells, "name"))
