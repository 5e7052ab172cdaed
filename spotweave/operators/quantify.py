"""Molecules counted when reads fit several genes, transcripts or barcodes: EM, evidence-weighted correction, spliced and unspliced layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.transcripts import introns
from spotweave.sources.scratch import drop, written


# Compatibility classes ---------------------------------------------------------


def classes(hits: DataFrame, keys: list[str], unit: str, target: str, weight: str | None = None) -> DataFrame:
    """(keys, targets, n): molecules that fit the same set of targets, as an ordered array of (t, w).

    ``hits`` has a row for each target that a molecule (``unit``) fits; of repeated rows the largest weight counts.  Rows with a
    null key, unit or target, or a weight that isn't above 0, take no part.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    known = hits.select(*keys, unit, F.col(target).alias("t"), w.alias("w")).dropna().where("w > 0")
    one = known.groupBy(*keys, unit, "t").agg(F.max("w").alias("w"))
    sets = one.groupBy(*keys, unit).agg(F.array_sort(F.collect_list(F.struct("t", "w"))).alias("targets"))
    return sets.groupBy(*keys, "targets").agg(F.count("*").alias("n"))


def em_counts(
    hits: DataFrame, keys: list[str] = ("cell",), unit: str = "umi", target: str = "gene", weight: str | None = None, tolerance: float = 1e-3, rounds: int = 100
) -> DataFrame:
    """(keys, target, n): expected molecules of each target, by expectation maximisation within each group of ``keys``.

    Molecules are reduced to classes of equal target sets.  Those with one
    target count as they are.  The others are shared out among their targets:
    at first evenly (by weight), then in each round by weight times the
    target's count of the round before.  In a round counts meet members by
    (keys, target) and shares are summed within a class, so no group of keys
    has to fit a task.  Each round's counts are written, which cuts lineage,
    and those before them dropped.  Rounds end when no count of at least 0.01
    changes by more than ``tolerance`` of itself, or after ``rounds``; with
    ``tolerance`` 0 exactly that many are made.  The sum over targets stays
    the number of molecules.
    """
    keys = list(keys)
    known = written(classes(hits, keys, unit, target, weight).withColumn("cls", F.monotonically_increasing_id()), "classes")
    single = known.where("size(targets) = 1").groupBy(*keys, F.col("targets")[0]["t"].alias("t")).agg(F.sum("n").cast("double").alias("n"))
    members = known.where("size(targets) > 1").select(*keys, "cls", F.col("n").alias("m"), F.explode("targets").alias("x")).select(*keys, "cls", "m", "x.t", "x.w")
    of_class = Window.partitionBy(*keys, "cls")

    def counted(shares: DataFrame) -> DataFrame:
        total = F.sum("p").over(of_class)
        # Counts that have fallen to nothing everywhere in a class leave it shared by weight.
        part = F.when(total > 0, F.col("p") / total).otherwise(F.col("w") / F.sum("w").over(of_class))
        shared = shares.select(*keys, "t", (F.col("m") * part).alias("n"))
        return written(single.unionByName(shared).groupBy(*keys, "t").agg(F.sum("n").alias("n")), "counts")

    now = counted(members.withColumn("p", F.col("w")))
    for _ in range(rounds):
        before = now
        now = counted(members.join(before, [*keys, "t"]).withColumn("p", F.col("w") * F.col("n")).drop("n"))
        if tolerance:
            old, new = before.withColumnRenamed("n", "old"), now.where("n >= 0.01")
            worst = new.join(old, [*keys, "t"]).agg(F.max(F.abs(F.col("n") - F.col("old")) / F.col("n"))).first()[0]
        drop(before)
        if tolerance and (worst is None or worst <= tolerance):
            break
    return now.withColumnRenamed("t", target)


# Evidence-weighted correction and collapse ---------------------------------------


def _masked(df: DataFrame, c: str, by: list[str], key: str, p: str) -> DataFrame:
    """Each string once for each way to leave one base out of sight: what stays in sight as a number."""
    places = df.withColumn(p, F.explode(F.when(F.length(c) > 0, F.sequence(F.lit(1), F.length(c)))))
    seen = [F.substring(c, F.lit(1), F.col(p) - 1), F.substring(c, F.col(p) + 1, F.length(c))]
    return places.withColumn(key, F.xxhash64(*by, p, *seen))


def one_mismatch(left: DataFrame, right: DataFrame, a: str, b: str, by: list[str] = ()) -> DataFrame:
    """(by, a, b, p): pairs of strings of one length that differ in exactly one base, the p-th, by an equi-join on what stays in sight with one base hidden.

    Each string comes once for each of its bases, which sizes guessed from files don't tell, so neither side is sent to all.
    """
    x, y = _masked(left.select(*by, a), a, by, "_h", "p"), _masked(right.select(*by, b), b, by, "_h", "_p")
    pairs = x.join(y.hint("merge"), ["_h", *by]).where((F.col("p") == F.col("_p")) & (F.col(a) != F.col(b)))
    # Different strings may have one number.
    same = (F.length(a) == F.length(b)) & (F.substring(a, F.lit(1), F.col("p") - 1) == F.substring(b, F.lit(1), F.col("p") - 1)) & (F.substring(a, F.col("p") + 1, F.length(a)) == F.substring(b, F.col("p") + 1, F.length(b)))
    return pairs.where(same).select(*by, a, b, "p")


def correct_by_evidence(reads: DataFrame, whitelist: DataFrame, read_id: str = "read_id", barcode: str = "bc", quality: str = "bc_qual", entry: str = "barcode", least: float = 0.975, pseudo: float = 1.0) -> DataFrame:
    """(read_id, barcode, posterior) of each read whose barcode is listed, or has one neighbour that explains it best.

    A candidate is an entry that differs in one base.  Its weight is the number of reads that show it exactly, plus ``pseudo``, times the
    chance of a wrong base at the place where it differs (from the Phred quality, as printed at offset 33; without one, 0.1).  The candidate with
    the largest weight is taken if it has at least ``least`` of all its rivals' and its own; of equals the
    smaller.  Distinct barcodes meet the whitelist, not reads; reads come back for their qualities.
    """
    listed = whitelist.select(F.col(entry).alias("entry")).distinct()
    known = reads.where(F.col(barcode).isNotNull()).select(F.col(read_id).alias("read_id"), F.col(barcode).alias("bc"), F.col(quality).alias("q"))
    # Distinct barcodes, written so that reads are counted once; sizes guessed from files, which hold ids in place of barcodes, would send the whitelist to all.
    seen = known.groupBy("bc").agg(F.count("*").alias("n")).join(listed.select(F.col("entry").alias("hit")).hint("merge"), F.col("bc") == F.col("hit"), "left")
    seen = written(seen, "barcodes")
    exact = seen.where("hit is not null").select("bc", "n")
    near = one_mismatch(seen.where("hit is null").select("bc"), listed, "bc", "entry")
    weighed = near.join(exact.withColumnRenamed("bc", "entry").hint("merge"), "entry", "left").withColumn("n", F.coalesce("n", F.lit(0)) + pseudo)
    candidates = weighed.groupBy("bc").agg(F.collect_list(F.struct("entry", "p", "n")).alias("c"))
    candidates = candidates.unionByName(exact.select("bc"), allowMissingColumns=True)
    # Three entries for each base at most, so the array is short.
    chance = lambda x: F.coalesce(F.pow(F.lit(10.0), -(F.ascii(F.substring(F.col("q"), x["p"], F.lit(1))) - 33) / 10), F.lit(0.1))
    odds = F.transform("c", lambda x: F.struct((x["n"] * F.when(F.length("q") >= x["p"], chance(x)).otherwise(0.1)).alias("w"), x["entry"].alias("entry")))
    scored = known.join(candidates.hint("merge"), "bc").withColumn("o", odds)
    best = F.reduce("o", F.struct(F.lit(-1.0).alias("w"), F.lit("").alias("entry")), lambda a, x: F.when((x["w"] > a["w"]) | ((x["w"] == a["w"]) & (x["entry"] < a["entry"])), x).otherwise(a))
    total = F.reduce(F.array_sort(F.transform("o", lambda x: x["w"])), F.lit(0.0), lambda a, x: a + x)
    scored = scored.withColumn("b", F.when(F.col("c").isNull(), F.struct(F.lit(1.0).alias("w"), F.col("bc").alias("entry"))).otherwise(best))
    posterior = F.when(F.col("c").isNull(), F.lit(1.0)).otherwise(F.col("b.w") / total)
    return scored.select("read_id", F.col("b.entry").alias("barcode"), posterior.alias("posterior")).where(F.col("c").isNull() | (F.col("posterior") >= least))


def one_gene_a_umi(reads: DataFrame, keys: list[str] = ("cell",), umi: str = "umi", gene: str = "gene") -> DataFrame:
    """(keys, umi, gene, n): each UMI of a cell with the one gene that most of its reads show; with two such genes it counts for neither."""
    per = reads.select(*keys, umi, gene).dropna().groupBy(*keys, umi, gene).agg(F.count("*").alias("n"))
    top = per.groupBy(*keys, umi).agg(F.max(F.struct("n", gene)).alias("best"), F.max("n").alias("most"), F.collect_list("n").alias("all"))
    alone = F.size(F.filter("all", lambda x: x == F.col("most"))) == 1
    return top.where(alone).select(*keys, umi, F.col(f"best.{gene}").alias(gene), F.col("best.n").alias("n"))


def collapse_once(counted: DataFrame, keys: list[str] = ("cell", "gene"), umi: str = "umi", n: str = "n") -> DataFrame:
    """(keys, umi, into, n): each UMI with the one it is taken for: of those that differ in one base and have more reads (of equal reads: come later), the one with most; itself without any.

    One step, from the UMI that was read to its neighbour, whatever that one in turn is taken for.
    """
    keys = list(keys)
    own = counted.select(*keys, F.col(umi).alias("u"), F.col(n).alias("n"))
    pairs = one_mismatch(own, own.withColumnRenamed("u", "v"), "u", "v", keys)
    pairs = pairs.join(own, [*keys, "u"]).join(own.select(*keys, F.col("u").alias("v"), F.col("n").alias("m")), [*keys, "v"])
    more = pairs.where((F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("v") > F.col("u"))))
    best = more.groupBy(*keys, "u").agg(F.max(F.struct("m", "v")).alias("b")).select(*keys, "u", F.col("b.v").alias("into"))
    return own.join(best, [*keys, "u"], "left").select(*keys, F.col("u").alias(umi), F.coalesce("into", "u").alias("into"), "n")


def count_collapsed(reads: DataFrame, keys: list[str] = ("cell",), umi: str = "umi", gene: str = "gene") -> DataFrame:
    """(keys, gene, n): UMIs of each gene after a UMI's one gene is chosen and near UMIs are taken for one."""
    keys = list(keys)
    into = collapse_once(one_gene_a_umi(reads, keys, umi, gene), [*keys, gene], umi)
    return into.select(*keys, gene, "into").distinct().groupBy(*keys, gene).agg(F.count("*").alias("n"))


# Spliced, unspliced, ambiguous ------------------------------------------------------


def splice_verdicts(reads: DataFrame, transcripts: DataFrame, exact_junctions: bool = True, width: int = 10_000, keep: list[str] = ()) -> DataFrame:
    """(name, *keep, gene, verdict) of the reads that lie within transcripts of exactly one gene.

    ``reads`` (name, chrom, strand, start, end, blocks) holds an alignment a row.  A transcript that spans all of a read holds it as exons do, if
    each block lies in an exon and (``exact_junctions``) each gap is one of its introns, else as the unspliced transcript does.  A read is spliced if
    all transcripts of its gene that span it hold it the first way, unspliced if all hold it the second way, else
    ambiguous.  ``keep`` names columns of a read that are carried along, so that nothing has to be joined to the reads again.

    A transcript that spans a read lies in the bin where the read starts, so reads come once, with what is compared and no more.
    """
    near = ["chrom", "strand", "_bin"]
    r = reads.select("name", *keep, "chrom", "strand", "start", "end", "blocks", F.floor(F.col("start") / width).alias("_bin"))
    bins = F.sequence(F.floor(F.col("start") / width), F.floor(F.greatest(F.col("end") - 1, F.col("start")) / width))
    t = transcripts.select("gene", "chrom", "strand", F.col("start").alias("_from"), F.col("end").alias("_to"), "exons", F.explode(bins).alias("_bin"))
    spans = (F.col("start") >= F.col("_from")) & (F.col("end") <= F.col("_to")) & (F.col("start") < F.col("_to")) & (F.col("_from") < F.col("end"))
    pairs = r.join(t.hint("merge"), near).where(spans)
    inside = F.forall("blocks", lambda b: F.exists("exons", lambda e: (e["start"] <= b["start"]) & (b["end"] <= e["end"])))
    if exact_junctions:
        gaps = introns("blocks")
        inside &= F.forall(gaps, lambda g: F.exists(introns(), lambda x: (x["start"] == g["start"]) & (x["end"] == g["end"])))
    held = pairs.select("name", *keep, "gene", inside.alias("whole"))
    per = held.groupBy("name", *keep).agg(F.min("gene").alias("gene"), F.max("gene").alias("_g"), F.bool_and("whole").alias("_all"), F.bool_or("whole").alias("_any")).where("gene = _g")
    verdict = F.when(F.col("_all"), "spliced").when(~F.col("_any"), "unspliced").otherwise("ambiguous")
    return per.select("name", *keep, "gene", verdict.alias("verdict"))


def velocity_counts(verdicts: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """(cell, gene, spliced, unspliced, ambiguous): UMIs by one verdict each, from (name, cell, umi) of the reads, or from verdicts that kept cell and umi.

    A UMI with spliced reads and no unspliced ones is spliced, the other way round unspliced, else ambiguous.
    """
    named = verdicts.dropna(subset=["cell", "umi"]) if cells is None else verdicts.join(cells.select("name", "cell", "umi").dropna(), "name")
    has = lambda v: F.max(F.when(F.col("verdict") == v, 1).otherwise(0))
    per = named.groupBy("cell", "gene", "umi").agg(has("spliced").alias("s"), has("unspliced").alias("u"))
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    return per.groupBy("cell", "gene").agg(one(F.col("s") > F.col("u")).alias("spliced"), one(F.col("u") > F.col("s")).alias("unspliced"), one(F.col("u") == F.col("s")).alias("ambiguous"))
