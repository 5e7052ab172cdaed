"""What a larger whitelist or annotation costs, seen in plans and in pairs compared."""

import random
import threading

import numpy as np
import pyarrow as pa
import pytest

from spotweave import plan_queries, quant_queries, queries  # noqa: F401  (these register the catalogue)
from pyspark.sql import functions as F
from spotweave.operators import barcodes as bc
from spotweave.plans import config, pipeline
from spotweave.sources import bus

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def edited(r, word, edits, bases="ACGT"):
    w = list(word)
    for _ in range(edits):
        i = r.randrange(len(w))
        if r.random() < 0.5:
            w[i] = r.choice(bases)
        else:
            del w[i]
            w.insert(r.randrange(len(w) + 1), r.choice(bases))
    return "".join(w)


@pytest.mark.parametrize("length, k, n", [(6, 2, 40), (9, 5, 300), (12, 6, 300), (16, 5, 400), (16, 8, 400), (40, 5, 100)])
def test_near_entries_against_all(length, k, n):
    """Entries found by their pieces are those at most three edits away that share a k-mer, and settle rows as all entries do."""
    r = random.Random(length + k)
    words = {"".join(r.choices("ACGT", k=length)) for _ in range(n // 4)}
    words |= {edited(r, w, r.randrange(1, 5)) for w in sorted(words) for _ in range(3)}
    index = bc.KmerIndex(sorted(words), [1 + (i % 9 == 0) for i in range(len(words))], k)
    qs = sorted({edited(r, w, r.randrange(5), "ACGTN") for w in sorted(words) for _ in range(2)})
    q = np.frombuffer("".join(qs).encode(), np.uint8).reshape(len(qs), length)
    d = index.digits(q)
    row, ids, found = index.near(d)
    want = {}
    for i in range(len(qs)):
        own = np.arange(len(words))
        apart = index.distances(d[i : i + 1], np.zeros(len(own), np.int64), own)
        shared = index.share_kmer(d[i : i + 1], np.zeros(len(own), np.int64), own)
        want |= {(i, int(j)): int(apart[j]) for j in np.flatnonzero((apart <= bc.NEAR) & shared)}
    assert dict(zip(zip(row.tolist(), ids.tolist(), strict=True), found.tolist(), strict=True)) == want and len(want) > len(qs) / 2
    first, entry, times, then = index.search(q)
    for i, b in enumerate(index.best(q)):
        if b is None:
            assert first[i] == bc.NONE
            continue
        assert (first[i], index.text[int(entry[i])].as_py(), times[i] > 1) == (b[0], b[1], b[2] > 1)
        if b[2] == 1:
            assert (None if then[i] == bc.NONE else then[i]) == b[3]


def test_large_whitelist_compares_few_pairs(monkeypatch):
    """With 400,000 entries a barcode meets some hundreds, not all of the seventh that share a 5-mer with it."""
    r = np.random.default_rng(3)
    words = np.frombuffer(b"ACGT", np.uint8)[r.integers(0, 4, (400_000, 16))]
    words = np.unique(words.view("S16").ravel()).view(np.uint8).reshape(-1, 16)
    index = bc.KmerIndex(words, np.ones(len(words), np.int64), 5)
    q = words[:200].copy()
    q[:, 7] = np.where(q[:, 7] == 65, 67, 65)
    made, real = [], bc.KmerIndex.distances
    monkeypatch.setattr(bc.KmerIndex, "distances", lambda self, q, row, ids: made.append(len(ids)) or real(self, q, row, ids))
    index.search(q)
    assert sum(made) < len(q) * len(words) / 50


def test_rows_leave_when_their_next_distance_is_known(monkeypatch):
    """Barcodes with one near entry met all entries three edits away, to learn that there is any."""
    r = np.random.default_rng(4)
    words = np.frombuffer(b"ACGT", np.uint8)[r.integers(0, 4, (900_000, 16))]
    words = np.unique(words.view("S16").ravel()).view(np.uint8).reshape(-1, 16)
    index = bc.KmerIndex(words, np.ones(len(words), np.int64), 5)
    q = index.digits(words[:500])
    q[:, 7] = (q[:, 7] + 1) % 4
    made, real = [], bc.KmerIndex.distances
    monkeypatch.setattr(bc.KmerIndex, "by_kmers", lambda self, q: (np.full(len(q), bc.NONE),) * 4)
    monkeypatch.setattr(bc.KmerIndex, "distances", lambda self, q, row, ids: made.append(len(ids)) or real(self, q, row, ids))
    index.search(np.frombuffer(b"ACGT", np.uint8)[q])
    assert sum(made) < 600 * len(q)


@pytest.mark.parametrize("bases, length", [("ACGT", 6), ("ACGT", 16), ("ACGTN", 16), ("ACGT", 32), ("ACGTN", 21)])
def test_few_edits_without_recurrence(bases, length):
    """Distances up to three edits from bits that differ, in place and moved by one place, are those of the recurrence; others are upper bounds."""
    r = random.Random(length)
    words = sorted({"".join(r.choices(bases, k=length)) for _ in range(150)})
    words = sorted({edited(r, w, r.randrange(5), bases) for w in words for _ in range(4)} | set(words))
    index = bc.KmerIndex(words, [1] * len(words), 5)
    own = np.repeat(np.arange(len(words)), 12)
    qs = [edited(r, words[i], r.randrange(6), "ACGTNX") for i in own]
    q = index.digits(np.frombuffer("".join(qs).encode(), np.uint8).reshape(len(qs), length))
    own[::4] = np.random.default_rng(1).integers(0, len(words), len(own[::4]))
    got, want = index.few(index.pack(q), np.arange(len(qs)), own), index.distances(q, np.arange(len(qs)), own)
    assert {0, 1, 2, 3} <= set(want.tolist()) and (np.where(want <= 3, want, 4) == np.minimum(got, 4)).all() and (got >= want).all()


def test_near_barcodes_do_without_the_recurrence(monkeypatch):
    """Every pair that seeds brought together went through all columns of the recurrence, and rows without an entry three edits away met all that share a k-mer."""
    r = np.random.default_rng(5)
    words = np.frombuffer(b"ACGT", np.uint8)[r.integers(0, 4, (300_000, 16))]
    words = np.unique(words.view("S16").ravel()).view(np.uint8).reshape(-1, 16)
    index = bc.KmerIndex(words, np.ones(len(words), np.int64), 5)
    q = words[:300].copy()
    q[:, 7] = np.where(q[:, 7] == 65, 67, 65)
    want = index.by_kmers(index.digits(q))
    met, open_, near, by_kmers = [], [], bc.KmerIndex.met, bc.KmerIndex.by_kmers

    def no_recurrence(self, *args, **kwargs):
        with monkeypatch.context() as m:
            m.setattr(bc.KmerIndex, "distances", lambda *_: pytest.fail("the recurrence"))
            found = list(near(self, *args, **kwargs))
        met.append(len(found))
        return found

    monkeypatch.setattr(bc.KmerIndex, "met", no_recurrence)
    monkeypatch.setattr(bc.KmerIndex, "by_kmers", lambda self, q: open_.append(len(q)) or by_kmers(self, q))
    found, one = index.search(q), want[2] == 1
    assert met and sum(open_) < len(q) / 10
    assert (found[0] == want[0]).all() and ((found[2] == 1) == one).all() and all((found[i][one] == want[i][one]).all() for i in (1, 3))


@pytest.mark.parametrize("name", ["barcode_correction_summary", "barcode_distance_histogram"])
def test_summaries_write_no_row_a_read(spark, monkeypatch, name):
    """Every read was written with its id, shuffled and joined, to get a few numbers."""
    made, real = {}, bc.written
    monkeypatch.setattr(bc, "written", lambda df, what: made.setdefault(what, real(df, what)))
    queries.QUERIES[name](spark, SMALL)
    assert "read_id" not in made["reads"].columns
    assert made["reads"].count() == queries.derived_reads(spark, SMALL).select("bc").distinct().count()


def test_counts_carry_no_read_ids(spark, monkeypatch):
    """Ids of reads were written, shuffled and joined on the way to counts that don't show them."""
    calls = spark.createDataFrame([(["ACGTACGT"],)], "bcs array<string>")
    assert bc.slim(bc.correct(calls, [spark.createDataFrame([("ACGTACGA",)], "barcode string")])).collect() == [("ACGTACGA",)]
    made, real = {}, bc.written
    monkeypatch.setattr(bc, "written", lambda df, what: made.setdefault(what, real(df, what)))
    assert queries.QUERIES["corrected_umi_knee"](spark, SMALL).count() > 0
    assert sorted(made["reads"].columns) == ["bc0", "gene", "umi"]


def test_calls_alike_count_as_their_reads(spark):
    """With calls grouped, summaries of corrections stay as they are, missing barcodes and parts without a match included."""
    entries = [spark.createDataFrame([(w,) for w in ws], "barcode string") for ws in (["ACGTACGT", "AAAATTTT", "AAAATTTG"], ["CCCCGGGG"])]
    bcs = [("ACGTACGT", "CCCCGGGG")] * 5 + [("ACGTACGA", "CCCCGGGT")] * 3 + [("AAAATTTC", None)] * 4 + [("GGGGGGGG", "TTTTTTTT")] * 2 + [(None, None)]
    calls = spark.createDataFrame([(f"r{i}", list(b)) for i, b in enumerate(bcs)], "read_id string, bcs array<string>")
    each, grouped = bc.correct(calls, entries), bc.correct(bc.alike(calls), entries, keep=["reads"])
    assert grouped.count() == 5
    for f in (bc.correction_summary, bc.distance_histogram):
        own = sorted(map(tuple, f(each).collect()))
        assert own == sorted(map(tuple, f(grouped, "reads").collect())) and sum(x[1] if f is bc.correction_summary else x[2] for x in own) == 14 + 10


@pytest.mark.parametrize("name", ["barcode_correct_full", "barcode_correct_slim", "barcode_correct_joined", "barcode_correction_summary", "barcode_distance_histogram"])
def test_whitelist_is_not_broadcast_by_a_guess(spark, name):
    assert "BroadcastHashJoin" not in plan(queries.QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["barcode_correct_by_evidence", "bus_corrected_sorted", "bus_gene_counts"])
def test_masked_whitelist_is_not_broadcast_by_a_guess(spark, name):
    """A whitelist with a row for each base of each entry was sent to the driver and to all executors."""
    made = queries.QUERIES[name](spark, SMALL)
    joins = [x for x in plan(made).splitlines() if "BroadcastHashJoin" in x]
    assert not [x for x in joins if any(c in x for c in ("_h#", "m#", "entry#", "barcode#", "to#", "bc#"))], joins


def test_reads_meet_transcripts_once(spark):
    """Reads were joined to bins, shuffled with their columns twice, and joined by name again for their cells."""
    text = plan(queries.QUERIES["velocity_layers"](spark, SMALL))
    initial = text.split("Initial Plan")[-1]
    joins = [x for x in initial.splitlines() if "Join" in x]
    assert len(joins) == 1 and "name" not in joins[0], joins


def counted_reads(spark, n=60):
    """Reads whose sequence is made by a function that counts its calls."""
    made = spark.sparkContext.accumulator(0)

    def sequence(i):
        made.add(1)
        return "".join("ACGT"[(i % 7 * k + k) % 4] for k in range(28))

    reads = spark.range(0, n, 1, 4).select(F.concat(F.lit("r"), "id").alias("read_id"), F.udf(sequence)("id").alias("seq"), (F.col("id") % 3).cast("string").alias("gene"))
    return reads, made


def test_reads_are_made_once_for_correction(spark):
    """They were made for their distinct barcodes, for the join and for those without a barcode."""
    reads, made = counted_reads(spark)
    calls = reads.select("read_id", F.array(F.when(F.col("read_id") != "r7", F.substring("seq", 1, 16))).alias("bcs"))
    entries = spark.createDataFrame([("ACGTACGTACGTACGT",), ("AAAAAAAAAAAAAAAA",)], "barcode string")
    assert bc.correct(calls, [entries]).count() == 60
    assert made.value == 60


def test_reads_are_made_once_for_a_matrix(spark):
    """Cells, genes and summaries each made the reads anew, and dropping those without a barcode made them twice."""
    reads, made = counted_reads(spark)
    entries = spark.createDataFrame([("ACGTACGTACGTACGT", 1.0, 2.0), ("AAAAAAAAAAAAAAAA", 1.0, 3.0)], "barcode string, x double, y double")
    done = pipeline.barcodes_of(reads, config.KNOWN["visium"], [entries])
    m = pipeline.annotated_matrix(pipeline.count_reads(done, reads.select("read_id", "gene")), entries)
    assert m.obs.count() > 0 and made.value == 60


@pytest.mark.parametrize("name", ["annotated_run", "barcode_correct_slim", "corrected_umi_knee", "barcode_correct_joined", "barcode_correction_summary", "barcode_distance_histogram"])
def test_events_are_not_read_again(spark, name):
    assert "events.parquet" not in plan(queries.QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["bus_corrected_sorted", "bus_gene_counts"])
def test_bus_files_are_read_once(spark, name):
    """They were read for their barcodes and again for their records, by two tasks a run and two plans of the driver."""
    assert "BatchScan" not in plan(queries.QUERIES[name](spark, SMALL))


def test_driver_plans_no_data_source_for_bus_files(spark, monkeypatch):
    """For each step of a data source that it planned the driver kept a Python process, 367 MB of them with two reads."""
    monkeypatch.setattr(type(spark.dataSource), "register", lambda *_: pytest.fail("a data source"))
    assert queries.QUERIES["bus_gene_counts"](spark, SMALL).count() > 0


def test_bus_format_and_small_runs(spark, tmp_path):
    """The data source reads what tasks wrote; of many small runs a task reads several."""
    rows = [("ACGT", "CA", i, 1, 0) for i in range(500)]
    bus.write_bus(spark.createDataFrame(rows, bus.SCHEMA), f"file://{tmp_path}/out", 4, 2)
    spark.dataSource.register(bus.BusSource)
    assert sorted(map(tuple, spark.read.format("bus").load(f"file://{tmp_path}/out").collect())) == rows
    small = bus.read_bus(spark, f"file://{tmp_path}/out", 2)
    assert sorted(map(tuple, small.collect())) == rows
    assert small.rdd.getNumPartitions() == bus.RUNS * spark.sparkContext.defaultParallelism < 250


def sample_correction(spark):
    calls = spark.range(0, 400, 1, 4).select(F.concat(F.lit("r"), "id").alias("read_id"), F.array(F.concat(F.substring(F.md5(F.col("id").cast("string").cast("binary")), 1, 11), F.lit("ACGTA"))).alias("bcs"))
    return calls, calls.where("read_id < 'r2'").select(F.col("bcs")[0].alias("barcode"))


def test_sent_whitelist_is_neither_written_nor_joined(spark, monkeypatch):
    """It was written, measured and collected by jobs of its own, and joined twice to find barcodes that are entries."""
    calls, entries = sample_correction(spark)
    written = []
    monkeypatch.setattr(bc, "written", lambda df, what: written.append(what) or df)
    found = bc.best_matches(calls.select(F.col("bcs")[0].alias("bc")), entries)
    assert "Join" not in plan(found) and not written
    exact = entries.distinct().count()
    assert 0 < exact == found.where("exact and dist = 0 and margin is null and corr = bc").count() == found.where("exact").count() < found.count() == 400


@pytest.mark.parametrize("bases, length", [("ACGT", 3), ("ACGT", 16), ("ACGTN", 30), ("".join(map(chr, range(48, 112))), 20)])
def test_entries_are_found_and_share_buckets(bases, length):
    """Words of any width find themselves; what is shown one place apart has the bucket of the same bases in place."""
    r = random.Random(length)
    words = sorted({"".join(r.choices(bases, k=length)) for _ in range(300)})
    index = bc.KmerIndex(words[::2], [1] * len(words[::2]), 3)
    assert index.text.to_pylist() == words[::2]
    q = index.digits(np.frombuffer("".join(words).encode(), np.uint8).reshape(len(words), length))
    assert index.find(q).tolist() == [i // 2 if i % 2 == 0 else -1 for i in range(len(words))]
    places, packed = list(range(1, length - 1)), index.pack(q)
    own = index.bucket(q, packed, places, places)
    assert len(set(own.tolist())) > len(words) * 0.8 or length == 3
    for by in (-1, 1):
        moved = np.roll(q, by, axis=1)
        assert (index.bucket(moved, index.pack(moved), places, [c + by for c in places]) == own).all()


def test_barcodes_are_gathered_and_letters_beyond_ascii_match_nothing(spark):
    """Each batch's rest was a search of its own; a letter that Latin-1 lacks counted as a question mark."""
    batches = [pa.RecordBatch.from_arrays([pa.array([f"{i:03}" for i in range(a, b)], pa.string())], ["bc"]) for a, b in ((0, 5), (5, 5), (5, 18), (18, 20))]
    assert [x.to_pylist() for x in bc.gathered(iter(batches), "bc", 8)] == [[f"{i:03}" for i in range(a, min(a + 8, 20))] for a in (0, 8, 16)]
    found = bc.best_matches(spark.createDataFrame([("ACGTAC\u0416T",), ("ACGTAC\u00e9T",), ("ACGTAC?T",)], "bc string"), spark.createDataFrame([("ACGTAC?T",), (None,)], "barcode string"))
    assert {r["bc"]: (r["corr"], r["dist"], r["exact"]) for r in found.collect()} == {"ACGTAC\u0416T": ("ACGTAC?T", 1, False), "ACGTAC\u00e9T": ("ACGTAC?T", 1, False), "ACGTAC?T": ("ACGTAC?T", 0, True)}


def test_reads_are_not_sorted_for_their_corrections(spark):
    """All reads were sorted by barcode to meet the corrections, which are fewer."""
    calls, entries = sample_correction(spark)
    done = bc.correct(calls, [entries])
    assert "SortMergeJoin" not in plan(done) and "ShuffledHashJoin" in plan(done)
    assert done.count() == 400


def test_whitelists_are_collected_while_reads_are_written(spark, monkeypatch):
    """One waited for the other."""
    calls, entries = sample_correction(spark)
    begun, waits, real, collected = threading.Event(), [], bc.written, bc._collected
    monkeypatch.setattr(bc, "_collected", lambda *args: begun.set() or collected(*args))
    monkeypatch.setattr(bc, "written", lambda df, what: waits.append(begun.wait(30)) or real(df, what))
    assert bc.correct(calls, [entries]).count() == 400 and waits == [True]
