"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

Every document becomes the set of its distinct shingles (64-bit hashes).
Identical sets are one class.  All classes share one total order of tokens,
rarest first by a histogram of hash buckets over the whole corpus, so a linked
pair must share k tokens in short prefixes (n - ceil(t*n) + k tokens).

* light classes (size <= boundary) enumerate the 2-subsets of their prefix;
* heavy classes, and light ones large enough to link with a heavy one, post
  single tokens to inverted lists, which are scanned;
* the boundary minimises estimated emitted keys plus list lengths.

Lists are never expanded into all pairs.  Each member is first verified
against its list's most central member; after the components of those links
are known, only lists that still hold two components are joined, across
components, under exact position and size bounds.  So no link that could
change a component is missed, and a group of near copies costs linear work.

Edge cases: null or empty text has the empty set, links with nothing and is
its own component; repeated rows are returned once each; 1 to n-1 words form
one shingle; extra columns are ignored; an empty table gives no rows.  Rows
without a doc_id link by their text as others do; a component is named by its
least doc_id, and by null only where no row of it has one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm import text as tx
from spotweave.llm.common import bounded, connected_components, drop_written, unused, written

#: Buckets of the document-frequency histogram: fixed, so what is broadcast is 2 bytes each.
BUCKET_BITS = 18
#: Bytes of a class's sketch: counts of its tokens by hash, which bound an intersection from above.
SKETCH = 256
#: Sizes above this are heavy in any case.
MAX_LIGHT = 160
#: Lists estimated longer than this are dealt over several tasks before they are scanned; of so many classes one is looked at for the estimate.
LIST_ROWS, SEEN = 16_000, 64
#: Pairs that a task verifies, about.
PAIRS = 4096
#: Pairs of one class that share a copy of its sketch and set.
DEAL = 512
#: What tells rows of one doc_id, or without one, apart.
TID = "xxhash64(text)"


def _sets(slices, n):
    """For each slice: (batch, list of sorted distinct shingle arrays)."""
    for batch in slices:
        data, off = tx.raw(batch.column("text"))
        words, first = tx.word_hashes(data, off)
        sh, begin = tx.shingle_hashes(words, first, n)
        yield batch, [np.unique(sh[begin[i] : begin[i + 1]]) for i in range(batch.num_rows)]


def _class_of(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    if not len(s):
        return 0, 0
    mixed = tx.mix(s)
    one = mixed.sum(dtype=np.uint64) + np.uint64(len(s))
    two = tx.mix(mixed + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def need(n: int, m: int, num: int, den: int) -> int:
    """Least intersection of sets of n and m tokens with Jaccard >= num/den."""
    return -(-num * (n + m) // (num + den))


def histogram(docs: DataFrame, n: int) -> np.ndarray:
    """Ranks (uint16) of the hash buckets by the number of documents' shingles in them, over all documents."""
    size = 1 << BUCKET_BITS

    def count(batches):
        total = np.zeros(size, np.int64)
        for _, sets in _sets(tx.text_slices(batches, "text"), n):
            if sets:
                total += np.bincount((np.concatenate(sets) & np.uint64(size - 1)).astype(np.int64), minlength=size)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = rows.toPandas()
    total = np.zeros(size, np.int64)
    total[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return total


def shingle_classes(docs: DataFrame, n: int, num: int, den: int, total: np.ndarray, longer: np.ndarray, class_bits: int = 64) -> DataFrame:
    """(doc_id, tid, n, cls, cls2, cent, hot, keys, sketch): set size, class by two hashes, mean token rank, estimated list length, ordered prefix for k = 2.

    ``tid`` is a hash of the text, which tells rows of one doc_id apart and stands for the doc_id of a row that has none.
    """
    spark = docs.sparkSession
    mask = np.uint64(len(total) - 1)
    rank = np.empty(len(total), np.uint16)
    rank[np.argsort(total, kind="stable")] = np.arange(len(total)) * 65536 // len(total)
    shared = spark.sparkContext.broadcast((rank, longer.astype(np.float32)))
    drop = 64 - class_bits

    def make(batches):
        rank, extra = shared.value
        for batch, sets in _sets(tx.text_slices(batches, "text"), n):
            keys, cent, hot, sketch = [], [], [], []
            for s in sets:
                b = (s & mask).astype(np.int64)
                r = rank[b]
                p = min(len(s), len(s) - need_own(len(s), num, den) + 2)
                o = np.argsort(r, kind="stable")[:p]
                keys.append(s[o].view(np.int64))
                cent.append(float(r.mean()) if len(s) else 0.0)
                hot.append(float(extra[b[o]].sum()) if len(s) else 0.0)
                counts = np.bincount((s >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH)
                sketch.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
            sizes = np.array([len(s) for s in sets], np.int32)
            cls = [_class_of(s) for s in sets]
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tid"),
                    pa.array(sizes),
                    pa.array(np.array([c for c, _ in cls], np.int64) >> drop),
                    pa.array(np.array([c for _, c in cls], np.int64)),
                    pa.array(np.array(cent, np.float32)),
                    pa.array(np.array(hot, np.float32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(sketch, pa.binary()),
                ],
                ["doc_id", "tid", "n", "cls", "cls2", "cent", "hot", "keys", "sketch"],
            )

    return docs.select("doc_id", "text", F.expr(TID).alias("tid")).mapInArrow(
        make, "doc_id long, tid long, n int, cls long, cls2 long, cent float, hot float, keys array<long>, sketch binary"
    )


def need_own(n: int, num: int, den: int) -> int:
    """Least intersection of a set of n tokens with any partner."""
    return -(-num * n // den)


def choose_boundary(by_size, num: int, den: int) -> int:
    """The size up to which classes are light, from rows (n, classes, hot): least emitted keys plus list entries scanned."""
    count, hot = np.zeros(MAX_LIGHT + 2), np.zeros(MAX_LIGHT + 2)
    for size, c, h in by_size:
        count[min(size, MAX_LIGHT + 1)] += c
        hot[min(size, MAX_LIGHT + 1)] += h
    sizes = np.arange(MAX_LIGHT + 2)
    pre = sizes - np.array([need_own(int(s), num, den) for s in sizes])
    light = np.cumsum(count * (pre + 2) * (pre + 1) / 2)
    scan = count * (pre + 1) + hot
    best = (math.inf, 0)
    for x in range(MAX_LIGHT + 1):
        lowest = need_own(x + 1, num, den)
        best = min(best, (float(light[x] + scan[lowest:].sum()), x))
    return best[1]


def postings(classes: DataFrame, boundary: int, num: int, den: int) -> DataFrame:
    """(key, cls, info, cent): a row for each 2-subset of a light prefix and each token of a scanned one.

    ``info`` is size << 32 | position << 1 | (k - 1).
    """
    pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    lowest = need_own(boundary + 1, num, den)

    def make(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                size = batch.column("n").to_numpy()
                cls = batch.column("cls").to_numpy()
                cent = batch.column("cent").to_numpy()
                col = batch.column("keys")
                off = col.offsets.to_numpy()
                flat = col.values.to_numpy().view(np.uint64)
                key, info, row = [], [], []
                for i in range(len(size)):
                    n, own = int(size[i]), flat[off[i] : off[i + 1]]
                    if n == 0:
                        continue
                    if 2 <= n <= boundary:
                        if len(own) not in pairs:
                            pairs[len(own)] = np.triu_indices(len(own), 1)
                        a, b = pairs[len(own)]
                        key.append(tx.mix(own[a] * np.uint64(3) + tx.mix(own[b])))
                        info.append(n << 32 | b << 1 | 1)
                        row.append(np.full(len(a), i))
                    if n > boundary or n >= lowest:
                        p = n - need_own(n, num, den) + 1
                        key.append(own[:p])
                        info.append(n << 32 | np.arange(p) << 1)
                        row.append(np.full(p, i))
                if not key:
                    continue
                row = np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(key).view(np.int64)), pa.array(cls[row]), pa.array(np.concatenate(info).astype(np.int64)), pa.array(cent[row].astype(np.float32))],
                    ["key", "cls", "info", "cent"],
                )
        tx.give_back()

    return classes.select("cls", "n", "cent", "keys").mapInArrow(make, "key long, cls long, info long, cent float")


def dealt_postings(classes: DataFrame, many: int, boundary: int, num: int, den: int) -> DataFrame:
    """:func:`postings` with ``deal``: a list of more than about LIST_ROWS rows is dealt over several tasks; ``deal`` is parts << 32 | the row's part.

    Which lists are that long is seen in one of SEEN classes, by a hash: a list of LIST_ROWS rows is missed with a chance far below one
    in a million, whatever the corpus holds, and missing one costs time alone.  There are at most rows / LIST_ROWS of them, about.
    """
    whole = F.lit(1 << 32).cast("long")
    if many <= LIST_ROWS:  # no list is longer than the ``many`` classes
        return postings(classes, boundary, num, den).withColumn("deal", whole)
    seen = postings(classes.where(F.pmod(F.xxhash64("cls"), F.lit(SEEN)) == 0), boundary, num, den)
    long = seen.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * SEEN > LIST_ROWS / 2)
    long = written(long.select("key", (F.floor(F.col("n") * SEEN / LIST_ROWS) + 1).alias("parts")).where("parts > 1"), "long-lists", 1)
    posts = postings(classes, boundary, num, den)
    if long.isEmpty():
        return posts.withColumn("deal", whole)
    parts = F.coalesce("parts", F.lit(1)).cast("long")
    part = F.pmod(F.col("cls").bitwiseAND(0x7FFFFFFF), parts)
    return posts.join(bounded(long), "key", "left").withColumn("deal", F.shiftleft(parts, 32).bitwiseOR(part)).drop("parts")


def _possible(a: str, b: str, num: int, den: int):
    """Whether postings a and b of one key can be the first shared ones of a linked pair."""
    n = lambda x: f"shiftright({x}.info, 32)"
    pos = lambda x: f"shiftright({x}.info & 4294967295, 1)"
    least = f"ceil({num} * ({n(a)} + {n(b)}) / {num + den}.0)"
    return F.expr(
        f"{n(a)} * {den} >= {n(b)} * {num} and {n(b)} * {den} >= {n(a)} * {num}"
        f" and {pos(a)} <= {n(a)} - {least} + ({a}.info & 1) and {pos(b)} <= {n(b)} - {least} + ({b}.info & 1)"
    )


def linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, n: int, num: int, den: int, class_bits: int = 64) -> DataFrame:
    """Those rows (u, v) of ``pairs`` whose classes' whole shingle sets reach the threshold.

    Sketches, which never underestimate an intersection, sort out most others before whole sets are moved.
    A class with more than DEAL pairs has a copy of its sketch and set for each DEAL of them, so its pairs
    spread over as many keys.
    """
    parts = pairs.count() // PAIRS + 1
    ends = pairs.select(F.explode(F.array("u", "v")).alias("cls"))
    crowded = ends.groupBy("cls").agg(F.floor(F.count("*") / DEAL).cast("int").alias("more")).where("more > 0")
    crowded = bounded(written(crowded, "crowded", parts))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("more", F.lit(0)))).alias("copy")

    def dealt(rows: DataFrame, end: str, other: str) -> DataFrame:
        more = crowded.select(F.col("cls").alias(end), F.col("more"))
        at = F.pmod(F.xxhash64(F.lit(1), other), F.coalesce("more", F.lit(0)) + 1).cast("int")
        return rows.join(more, end, "left").withColumn("copy", at).drop("more")

    def copied(rows: DataFrame, end: str, *cols) -> DataFrame:
        return rows.join(crowded, "cls", "left").select(F.col("cls").alias(end), copies, *cols)

    both = dealt(pairs, "u", "v").join(copied(reps, "u", F.col("n").alias("nu"), F.col("sketch").alias("su")), ["u", "copy"]).drop("copy")
    both = dealt(both, "v", "u").join(copied(reps, "v", F.col("n").alias("nv"), F.col("sketch").alias("sv")), ["v", "copy"]).drop("copy")

    def prune(batches):
        for batch in batches:
            rows = batch.num_rows
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(rows, SKETCH)
                for c in ("su", "sv")
            )
            most = np.minimum(a, b)
            known = (most < 255).all(axis=1)
            total = batch.column("nu").to_numpy().astype(np.int64) + batch.column("nv").to_numpy()
            same = most.sum(axis=1, dtype=np.int64)
            keep = ~known | (den * same >= num * (total - same))
            yield batch.select(["u", "v"]).filter(pa.array(keep))
        tx.give_back()

    pairs = written(both.select("u", "v", "nu", "nv", "su", "sv").mapInArrow(prune, "u long, v long"), "pairs", parts)
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("cls")).distinct()
    wanted = written(wanted.join(reps.select("cls", "doc_id", "tid"), "cls"), "wanted", parts)
    few = wanted.where("doc_id is not null").select("doc_id").distinct()
    bare = wanted.where("doc_id is null").select("tid").distinct()

    def make(batches):
        for batch, sets in _sets(tx.text_slices(batches, "text"), n):
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            cls = [_class_of(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array([c for c, _ in cls], np.int64) >> (64 - class_bits)),
                    pa.array(np.array([c for _, c in cls], np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                ["cls", "cls2", "tokens"],
            )

    texts = docs.select("doc_id", "text").join(bounded(few), "doc_id", "left_semi")
    if not bare.isEmpty():
        # Equal texts without a doc_id can be many; one of each is enough.
        unnamed = docs.where("doc_id is null").select("doc_id", "text", F.expr(TID).alias("tid")).join(bounded(bare), "tid", "left_semi")
        texts = texts.union(unnamed.dropDuplicates(["tid"]).select("doc_id", "text"))
    sets = texts.select("text").mapInArrow(make, "cls long, cls2 long, tokens array<long>")
    if "cls0" in reps.columns:
        sets = sets.join(bounded(reps.select(F.col("cls0").alias("cls"), "cls2", F.col("cls").alias("own"))), ["cls", "cls2"]).select(F.col("own").alias("cls"), "tokens")
    else:
        sets = sets.drop("cls2")
    full = dealt(pairs, "v", "u").join(copied(sets, "v", F.col("tokens").alias("tb")), ["v", "copy"]).drop("copy")
    full = dealt(full, "u", "v").join(copied(sets, "u", F.col("tokens").alias("ta")), ["u", "copy"])
    # Row by row in the JVM: a batch of whole sets for Python would have no bound but its rows.
    same = F.size(F.array_intersect("ta", "tb")).cast("long")
    enough = den * same >= num * (F.size("ta") + F.size("tb") - same)
    links = written(full.where(enough).select("u", "v").distinct(), "links", parts)
    drop_written(crowded, pairs, wanted)
    return links


def classes_and_components(docs: DataFrame, n: int, num: int, den: int, class_bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: each row's class (doc_id, tid, n, cls), the classes with a row that stands for each (cls, doc_id), and the components of linked classes (node, component).

    ``class_bits`` are those of a class's first hash that are used; fewer only make collisions, which a second hash tells apart.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = histogram(docs, n)
    noise = float(np.median(total))
    longer = np.maximum(total - 2 * noise - 8, 0)
    meta = written(shingle_classes(docs, n, num, den, total, longer, class_bits), "classes")
    # A class is represented by a row with a doc_id where it has one.
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid", "n")

    def represented(meta: DataFrame, *more: str) -> DataFrame:
        reps = meta.where("n > 0").groupBy("cls").agg(
            F.min(own).alias("r"), F.first("hot").alias("hot"), F.first("sketch").alias("sketch"), F.min("cls2").alias("cls2"), F.max("cls2").alias("hi"), *[F.first(c).alias(c) for c in more]
        )
        return written(reps.select("cls", "r.doc_id", "r.tid", "r.n", "hot", "sketch", "cls2", "hi", *more), "reps")

    reps = represented(meta)
    if not reps.where("cls2 <> hi").isEmpty():
        # Different sets of one hash: classes get their number from both hashes.
        meta = written(meta.withColumnRenamed("cls", "cls0").withColumn("cls", F.when(F.col("n") > 0, F.xxhash64("cls0", "cls2")).otherwise(F.col("cls0"))), "classes")
        reps = represented(meta, "cls0")
    reps = reps.drop("hi")
    by_size = (
        reps.groupBy(F.least("n", F.lit(MAX_LIGHT + 1)).alias("size")).agg(F.count("*").alias("c"), F.sum("hot").alias("h")).collect()
    )
    boundary = choose_boundary([(r["size"], r["c"], r["h"]) for r in by_size], num, den)
    m, r = meta.alias("m"), reps.alias("r")
    same = (F.col("m.cls") == F.col("r.cls")) & (F.col("m.n") == F.col("r.n"))
    for c in ("doc_id", "tid"):
        same &= F.col(f"m.{c}").eqNullSafe(F.col(f"r.{c}"))
    one = m.join(r, same, "left_semi").dropDuplicates(["cls", "doc_id"])
    posts = dealt_postings(one, sum(r["c"] for r in by_size), boundary, num, den)

    near = Window.partitionBy("key", "deal").orderBy(F.desc("cent"), "cls")
    member = F.struct("cls", "info")
    parts, part = F.shiftright("deal", 32), F.col("deal").bitwiseAND(0xFFFFFFFF)
    lists = (
        posts.withColumn("centre", F.first(member).over(near))
        .withColumn("others", F.coalesce(F.lag("cls").over(near), F.lead("cls").over(near)))
        # A row alone in its part can still have partners in the list's other parts.
        .where(F.col("others").isNotNull() | (parts > 1))
        .drop("others", "cent")
    )
    lists = written(lists, "lists")
    first = lists.select(member.alias("a"), F.col("centre").alias("b")).where("a.cls <> b.cls")
    # The centres of lists that were dealt over several tasks meet here.
    heads = lists.where((F.col("cls") == F.col("centre.cls")) & (parts > 1)).select("key", member.alias("b"), part.alias("part"))
    zero = Window.partitionBy("key").orderBy("part")
    heads = heads.withColumn("a", F.lag("b").over(zero)).where("a is not null").select("a", "b")
    pairs = (
        first.union(heads.select("a", "b"))
        .where(_possible("a", "b", num, den))
        .select(F.least("a.cls", "b.cls").alias("u"), F.greatest("a.cls", "b.cls").alias("v"))
        .distinct()
    )
    pairs = written(pairs, "first-pairs")
    links = linked(pairs, docs, reps, n, num, den, class_bits)
    comps = written(connected_components(links), "components")

    known = lists.select("key", "deal", "cls", "info").join(
        comps.withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("component", F.coalesce("component", "cls"))
    open_keys = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    rest = written(known.join(open_keys, "key"), "open")
    drop_written(lists, links)
    # A list's parts meet each other part by part: (lo, hi) is a pair of parts, and a key of its own.
    every = rest.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    every = every.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "cls", "info", "component")
    a, b = every.alias("a"), every.alias("b")
    meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.lo") == F.col("b.lo")) & (F.col("a.hi") == F.col("b.hi"))
    # Within a part every pair is made once; between two, from one to the other.
    meet &= F.when(F.col("a.lo") == F.col("a.hi"), F.col("a.component") < F.col("b.component")).otherwise(
        (F.col("a.part") == F.col("a.lo")) & (F.col("b.part") == F.col("a.hi")) & (F.col("a.component") != F.col("b.component"))
    )
    across = (
        a.join(b, meet & _possible("a", "b", num, den))
        .select(F.least("a.cls", "b.cls").alias("u"), F.greatest("a.cls", "b.cls").alias("v"))
        .distinct()
    )
    left = written(across.join(pairs, ["u", "v"], "left_anti"), "second-pairs")
    more = linked(left, docs, reps, n, num, den, class_bits)
    # The first pass's components are stars already; only new links are added to them.
    stars, comps = comps, connected_components(more.union(comps.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    drop_written(rest, pairs, left, more, stars)
    return meta, reps, comps


def ngram_jaccard_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, class_bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``; see the module's text.

    Two documents link when den * |intersection| >= num * |union| of their n-word shingle sets.
    """
    meta, reps, comps = classes_and_components(docs, n, num, den, class_bits)
    lowest = reps.select("cls", "doc_id").join(comps.withColumnRenamed("node", "cls"), "cls")
    of_component = lowest.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = lowest.join(of_component, "component").select("cls", "component_id")
    return (
        meta.select("doc_id", "n", "cls")
        .join(reps.select("cls", F.col("doc_id").alias("own")), "cls", "left")
        .join(named, "cls", "left")
        .select(
            "doc_id",
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "own")).alias("component_id"),
        )
    )


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id, a row without a doc_id only where none has one.

    Rows are told apart by doc_id and text, so rows of one doc_id stay or go each by its own component; of rows of one doc_id
    in one component, the one with the least hash of its text stays.  Of rows with the same doc_id and the same text one stays,
    the least by its other columns.  A text without words is linked with nothing, so it stays.
    """
    meta, _, comps = classes_and_components(docs, n, num, den)
    rows = unused(docs, "rows")
    counted = meta.groupBy("cls", (F.col("n") > 0).alias("some"), F.col("doc_id").isNull().alias("none"), "doc_id", "tid").agg(F.count("*").alias(rows))
    grouped = counted.where("some").join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    first = grouped.groupBy("component").agg(F.min(F.struct("none", "doc_id", "tid", rows)).alias("r")).select("r.doc_id", "r.tid", f"r.{rows}")
    kept = first.unionByName(counted.where("not some").select("doc_id", "tid", rows))
    own, tid = unused(docs, "id"), unused(docs, "tid")
    kept = bounded(written(kept.select(F.col("doc_id").alias(own), F.col("tid").alias(tid), rows), "kept"))
    d, k = docs.alias("d"), kept.alias("k")
    on = F.col("d.doc_id").cast("long").eqNullSafe(F.col(f"k.{own}")) & (F.xxhash64(F.col("d.text").cast("string")) == F.col(f"k.{tid}"))
    joined = d.join(k, on).select("d.*", own, tid, rows)
    once = joined.where(F.col(rows) == 1).select([F.col(f"`{c}`") for c in docs.columns])
    # Columns that can't be put in order, such as maps, follow the least text of those that can.
    order = [F.col(f"`{f.name}`") for f in docs.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant", "interval"))]
    every = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    least = joined.where(F.col(rows) > 1).groupBy(own, tid).agg(F.min_by(every, F.struct(*order)).alias(rows))
    return once.unionByName(least.select(*[F.col(f"`{rows}`.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
