import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotweave.llm import mixing, nearest, oracles, packing, quality, secrets, sharding, token_counts, topk, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long, size string, h string, range string, record string"
PAD = ("L", None, "R", None)


def documents(spark, rows):
    """(doc_id, text[, source]) with the columns of documents and some whose names the operators use themselves."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *PAD) for r in rows]
    return spark.createDataFrame(full, DOC).repartition(4)


def prose(seed, n):
    r = random.Random(seed)
    words = ["the", "of", "and", "orange", "tion", "éau", "sentence", "Thor", "x1", "don't"]
    return [" ".join(r.choices(words, k=r.choice([0, 1, 4, 30, 200]))) + r.choice(["", ".", "\nmore."]) for _ in range(n)]


ODD = [(1000, None), (1001, ""), (1002, " \n"), (1003, "same"), (1004, "same"), (1004, "same"), (1005, "word " * 30_000), (None, "no id")]


def sql_rows(docs, sql, name="documents"):
    con = duckdb.connect()
    frame = docs.toArrow()  # noqa: F841 (read by the view)
    con.execute(f"create table {name} as select * from frame")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return [dict(zip(names, r, strict=True)) for r in got.fetchall()]


def same(spark_df, want):
    cols = sorted(spark_df.columns)
    key = lambda rows: sorted([tuple(r[c] for c in cols) for r in rows], key=repr)
    assert key(spark_df.collect()) == key(want)


# Quality ------------------------------------------------------------------------


def test_statistics_of_odd_texts():
    x = quality.statistics(pa.array(["", "Abc abc abc.\n", "é!", "word " * 1000], pa.large_string()))
    assert x.shape == (4, len(quality.NAMES)) and np.isfinite(x).all() and (x[0] == 0).all()
    at = dict(zip(quality.NAMES, x[1], strict=True))
    assert np.isclose(at["log_words"], np.log1p(3)) and np.isclose(at["distinct"], 2 / 3) and np.isclose(at["upper"], 1 / 13)


def test_isotonic_against_brute_force():
    r = np.random.default_rng(0)
    y, w = r.random(60), r.integers(1, 9, 60).astype(float)
    at, level = quality.isotonic(np.arange(60.0), w, y)
    # Min-max formula of the isotonic fit.
    fit = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    assert (np.diff(level) >= 0).all() and np.allclose(sorted(set(np.round(fit, 9))), sorted(set(np.round(level, 9))))
    assert len(at) == len(level)


def test_classifier_on_held_out_documents(spark):
    r = random.Random(2)
    good = ["the quick orange of and sentence".split(), "tion of the and".split()]
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        w = r.choices(r.choice(good), k=r.randrange(20, 80))
        rows.append((i, " ".join(x + "###" for x in w) if bad else " ".join(w) + "."))
        labels.append((i, 0 if bad else 1))
    labels += [(0, None), (1, 7)]
    got = quality.score_documents(documents(spark, rows + ODD), spark.createDataFrame(labels, "doc_id long, quality int")).toPandas()
    assert len(got) == 600 + len(ODD) and got["score"].between(0, 1).all()
    own = got[got["doc_id"].lt(600) & got["held_out"]]
    assert len(own) > 60 and ((own["doc_id"] % 3 != 0) == (own["predicted"] == 1)).all()
    assert all(h == (zlib.crc32(str(int(d)).encode()) % 5 == 0) for d, h in zip(got["doc_id"], got["held_out"], strict=True) if d == d)
    kept = quality.keep_good(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert 380 <= kept.count() <= 420 and kept.columns == documents(spark, rows).columns


def test_scores_against_a_dense_fit(spark):
    """Normal equations summed over tasks, ridge and calibration against numpy on all rows at once."""
    r = np.random.default_rng(8)
    d = len(quality.NAMES)
    stats = r.normal(size=(3000, d)).astype(np.float32)
    y = (stats[:, 0] + 0.3 * r.normal(size=3000) > 0).astype(float)
    part = r.integers(1, 5, 3000)
    rows = spark.createDataFrame([([float(v) for v in x], float(a), int(p)) for x, a, p in zip(stats, y, part, strict=True)], "stats array<float>, y double, part int").repartition(7)
    model = quality.fit(rows)
    x, own = stats[part < 4].astype(float), y[part < 4]
    assert np.allclose(model.centre, x.mean(0), atol=1e-6) and np.allclose(model.scale, x.std(0), atol=1e-5)
    z = np.column_stack((np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((x - x.mean(0)) / (x.std(0) + 1e-6), -6, 6) @ model.omega + model.phase), np.ones(len(x))))
    penalty = np.eye(quality.FEATURES + 1) * quality.RIDGE * len(x)
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ own)
    assert np.allclose(z @ weights, model.raw(x), atol=1e-6)
    held = stats[part == 4].astype(float)
    bins = np.round(model.raw(held) * quality.BINS / 3).astype(int)
    at = np.unique(bins)
    n = np.array([(bins == b).sum() for b in at], float)
    knots, levels = quality.isotonic(at * 3 / quality.BINS, n, np.array([y[part == 4][bins == b].mean() for b in at]))
    assert np.allclose(knots, model.knots) and np.allclose(levels, model.levels)
    scores = model.score(held)
    assert ((scores > 0.5) == (y[part == 4] == 1)).mean() > 0.7 and scores.min() >= 0 and scores.max() <= 1


def test_rows_of_one_id_go_by_their_own_text(spark):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        w = r.choices("the quick orange of and sentence tion".split(), k=40)
        rows.append((i, " ".join(x + "###" for x in w) if i % 3 == 0 else " ".join(w) + "."))
        labels.append((i, int(i % 3 != 0)))
    good, bad = rows[1][1], rows[0][1]
    shared = [(900, good), (900, bad), (None, good), (None, bad), (901, bad), (901, bad)]
    docs, marks = documents(spark, rows + shared), spark.createDataFrame(labels, "doc_id long, quality int")
    left = quality.keep_good(docs, marks)
    kept = {(x["doc_id"], x["text"]) for x in left.collect()}
    assert {x for x in kept if x[0] in (900, 901, None)} == {(900, good), (None, good)}
    assert left.columns == docs.columns and kept == {x for x in rows if x[0] % 3} | {(900, good), (None, good)}


def test_classifier_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_documents(documents(spark, ODD), none).collect()} == {0.5}
    assert quality.score_documents(documents(spark, []), none).count() == 0


# Mixing -----------------------------------------------------------------------------


def test_mix_against_sql(spark):
    rows = [(i, t, random.Random(i).choice(["a", "b", "ä", "Z", None, "a", "a"])) for i, t in enumerate(prose(1, 300))]
    docs = documents(spark, rows + [(d, t, "odd") for d, t in ODD])
    out = mixing.mix_sources(docs)
    same(out, sql_rows(docs, oracles.MIX))
    got = out.toPandas()
    assert np.isclose(got.groupby("source", dropna=False)["target"].first().sum(), got["size"].sum())
    assert (got["taken"] <= 3 * got["size"]).all()
    for _, s in got.groupby("source", dropna=False):
        assert abs(s["taken"].sum() - s["target"].iloc[0]) <= s["size"].max() / 2 + 1
    assert mixing.mix_sources(documents(spark, [])).count() == 0


def test_rows_of_one_id_are_taken_by_their_text(spark):
    docs = documents(spark, [(1, "a b c", "x"), (1, "d " * 900, "x"), (1, None, "x"), (2, "e f", "y"), (2, "e f", "y")])
    times = {}
    for r in mixing._mix(docs).where("size > 0").collect():
        times.setdefault((r["doc_id"], r["size"]), []).append(r["taken"] // r["size"])
    got = {}
    for r in mixing.mixed_documents(docs).collect():
        got[r["doc_id"], len(r["text"].split())] = got.get((r["doc_id"], len(r["text"].split())), 0) + 1
    assert got == {k: round(sum(v) / len(v) + 1e-9) * len(v) for k, v in times.items() if round(sum(v) / len(v) + 1e-9)}


def test_mixed_documents_are_repeated(spark):
    docs = documents(spark, [(1, "a b c", "x"), (2, "d e", "y"), (3, None, "y")])
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_sources(docs).where("size > 0").collect()}
    got = {r["doc_id"]: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in times.items() if v}


# Sharding -----------------------------------------------------------------------------


@pytest.mark.parametrize("ranges,sample", [(768, 24_576), (6, 40)])
def test_shards_against_sql(spark, ranges, sample):
    texts = prose(3, 400)
    rows = [(i, t) for i, t in enumerate(texts)] + [(5000 + i, "a hot text " * 40) for i in range(200)] + [x for x in ODD if x[0]]
    docs = documents(spark, rows)
    out = sharding.shard_by_bytes(docs, ranges=ranges, sample=sample)
    same(out, sql_rows(docs, oracles.SHARD))
    got = out.toPandas()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_shards_of_nothing_and_files(spark, tmp_path):
    assert sharding.shard_by_bytes(documents(spark, [])).count() == 0
    docs = documents(spark, ODD)
    sharding.write_shards(docs, str(tmp_path / "s"), 3)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(ODD)


# Nearest and top-k -----------------------------------------------------------------------

BROKEN = [(7001, None), (7002, [0.0] * 8), (7003, [1.0] * 7 + [None]), (7004, [1.0] * 7 + [float("nan")]), (7005, [float("inf")] * 8), (None, [1.0] * 8), (7007, [])]


def vectors(spark, x, extra=()):
    return spark.createDataFrame([(i, [float(v) for v in row], 1) for i, row in enumerate(x)] + [(i, v, 1) for i, v in extra], "vec_id long, embedding array<float>, score int").repartition(3)


def test_nearest_recall_and_ties(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 8)).astype(np.float32)
    x[1000:1400] = x[50]
    got = nearest.nearest(vectors(spark, x, BROKEN)).toPandas()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hits = total = 0
    for q in range(0, 1500, 50):
        s = u @ u[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
        own = got[got["query_id"] == q].sort_values("rank")
        assert list(own["rank"]) == [1, 2, 3, 4, 5]
        assert np.allclose(own["score"], s[own["vec_id"].to_numpy()], atol=1e-12)
        hits += len(set(best) & set(own["vec_id"]))
        total += 5
    assert hits / total >= 0.9
    assert list(got[got["query_id"] == 50].sort_values("rank")["vec_id"]) == [1000, 1001, 1002, 1003, 1004]


def test_entries_go_to_the_blocks_that_visit_them(spark, monkeypatch):
    r = np.random.default_rng(8)
    centres = r.normal(size=(30, 8)) * 5
    x = (centres[np.arange(3000) % 30] + r.normal(size=(3000, 8)) * 0.05).astype(np.float32)
    table = vectors(spark, x, [])
    want = {tuple(g) for g in nearest.nearest(table, every=10).collect()}
    seen = []
    made = nearest.entries_by_block
    monkeypatch.setattr(nearest, "entries_by_block", lambda *a: seen.append(made(*a).cache()) or seen[-1])
    monkeypatch.setattr(nearest, "GROUP_QUERIES", 30)
    monkeypatch.setattr(nearest, "LEAST_CANDIDATES", 20)
    got = nearest.nearest(table, every=10).collect()
    # Ten blocks of queries: without knowing which visit a first half, every entry would go to each.
    copies = seen[0].count()
    assert copies < 0.4 * 10 * 3000 and seen[0].select("row").distinct().count() <= 3000
    near = lambda rows: {(g[0], g[2]) for g in rows}
    assert len(near(want) & near(got)) >= 0.9 * len(near(want)) and len(got) == 300 * 5
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    exact = {(q, int(j)) for q in range(0, 3000, 10) for j in [j for j in np.argsort(-(u @ u[q]))[:6] if j != q][:5]}
    assert len(exact & near(got)) >= 0.9 * len(exact)


def test_nearest_of_few(spark):
    got = nearest.nearest(vectors(spark, np.eye(8)[:3], BROKEN)).toPandas()
    assert list(got["vec_id"]) == [1, 2] and list(got["query_id"]) == [0, 0]
    assert nearest.nearest(vectors(spark, [], BROKEN[:1])).count() == 0


def test_vectors_of_other_lengths_and_repeated_ids(spark):
    x = [[1.0, 0.0, 0.0], [0.9, 0.1, 0.0], [0.0, 0.0, 1.0]]
    extra = [(50, [1.0]), (50, [0.0, 1.0]), (50, [1.0]), (4, [0.5, 0.5, 0.5, 0.5])]
    rows = [*enumerate(x), *extra]
    wide = np.zeros((len(rows), 4))
    for i, (_, v) in enumerate(rows):
        wide[i, : len(v)] = np.float32(v)
    unit = wide / np.linalg.norm(wide, axis=1)[:, None]
    for got, score in (
        (nearest.nearest(vectors(spark, x, extra)), unit @ unit.T),
        (topk.top_products(vectors(spark, x, extra)), np.floor(256 * wide) @ np.floor(256 * wide).T),
    ):
        want = []
        for i, (q, _) in enumerate(rows):
            if q % 50 == 0:
                others = sorted((-round(score[i, j], 9), rows[j][0]) for j in range(len(rows)) if j != i)[:5]
                want += [(q, k + 1, v, -s) for k, (s, v) in enumerate(others)]
        own = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got.collect()]
        assert sorted(own) == sorted(want)


def test_probe_is_measured_on_the_table():
    r = np.random.default_rng(5)
    spread = nearest.unit(r.normal(size=(2000, 32)))
    close = nearest.unit(np.repeat(r.normal(size=(40, 32)), 50, axis=0) + 0.05 * r.normal(size=(2000, 32)))
    books = lambda x: (nearest.kmeans(x[:, :16], 12, 1), nearest.kmeans(x[:, 16:], 12, 2))
    assert nearest.measured_probe(close, *books(close), 5) < 0.2 < nearest.measured_probe(spread, *books(spread), 5) <= 1


def test_multi_sequence_walks_in_order():
    r = np.random.default_rng(3)
    a, b = r.random(6), r.random(7)
    got = nearest.multi_sequence(a, b, np.ones((6, 7), int), 42)
    sums = [a[i] + b[j] for i, j in got]
    assert sums == sorted(sums) and len(set(got)) == 42


def test_top_products_against_brute_force(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 40)).astype(np.float32)
    x[300:330] = x[0]
    table = vectors(spark, x, [(7000, [0.0] * 40), (7001, None), (7002, [float("nan")] * 40)])
    same(topk.top_products(table), sql_rows(table, oracles.TOP, "embeddings"))
    got = topk.top_products(table).toPandas()
    q = np.vstack((np.floor(256 * x.astype(float)).astype(int), np.zeros((1, 40), int)))
    ids = np.array([*range(600), 7000])
    for i in np.flatnonzero(ids % 50 == 0):
        s = (q @ q[i]).astype(float)
        s[i] = -1e18
        best = np.lexsort((ids, -s))[:5]
        own = got[got["query_id"] == ids[i]].sort_values("rank")
        assert list(own["vec_id"]) == list(ids[best]) and list(own["score"]) == [int(v) for v in s[best]]


def test_top_products_of_huge_components():
    x = topk.whole(np.floor(256 * np.array([[2.0**30, 1.0], [2.0**30, -1.0], [1.0, 1.0]])))
    got = topk.search_block(x[:1], np.array([0]), x.T, np.arange(3), 5)
    assert got == [(0, 1, (2**38) ** 2 - 2**16), (0, 2, 2**46 + 2**16)]


@pytest.mark.parametrize("dims", [512, 1024])
def test_products_of_many_large_components(spark, dims):
    r = np.random.default_rng(dims)
    x = r.uniform(-30_000, 30_000, (120, dims)).astype(np.float32)
    got = {(g["query_id"], g["rank"]): (g["vec_id"], g["score"]) for g in topk.top_products(vectors(spark, x, [])).collect()}
    q = [[int(np.floor(256 * float(c))) for c in row] for row in x]
    for i in (0, 50, 100):
        scores = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in range(120) if j != i)[:5]
        assert [got[i, n + 1] for n in range(5)] == [(j, -s) for s, j in scores]


def test_a_score_that_fits_no_long_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)overflow|out of bounds|too large|too big"):
        topk.top_products(vectors(spark, np.full((2, 1024), 500_000.0), [])).collect()


def test_best_scores_go_from_block_to_block():
    r = np.random.default_rng(4)
    x = r.integers(-300, 300, (900, 48))
    q, rows = x[:7], np.arange(900)
    best = np.full((7, 5), -np.inf)
    found = [[] for _ in range(7)]
    for at in range(0, 900, 100):
        for i, j, s in topk.search_block(q, rows[:7], np.ascontiguousarray(x[at : at + 100].T), rows[at : at + 100], 5, best):
            found[i].append((-s, at + j))
    for i in range(7):
        want = sorted((-int(q[i] @ x[j]), j) for j in range(900) if j != i)[:5]
        assert sorted(found[i])[:5] == want


def test_top_products_of_nothing(spark):
    assert topk.top_products(vectors(spark, [], BROKEN[:1])).count() == 0
    assert [tuple(r) for r in topk.top_products(vectors(spark, [], [(50, []), (1, [])])).collect()] == [(50, 1, 1, 0)]


# Tokens -------------------------------------------------------------------------------------


def test_sections_against_brute_force(spark):
    rows = [(i, t + "\n\n  x" * (i % 3)) for i, t in enumerate(prose(5, 60))] + [x for x in ODD if x[0]]
    enc, _ = token_counts.tokenizer(token_counts.default_tokenizer())
    got = {}
    for r in token_counts.section_tokens(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for d, t in rows:
        ids, at, want = enc.encode_ordinary(t or ""), 0, {}
        data = (t or "").encode()
        for i in ids:
            line = data[:at].count(b"\n")
            want[line] = want.get(line, 0) + 1
            at += len(enc.decode_single_token_bytes(i))
        for copy in range(0, len(got[d]), max(r["section"] for r in got[d]) + 1):
            own = [r for r in got[d]][copy : copy + max(r["section"] for r in got[d]) + 1]
            assert {r["section"]: r["tokens"] for r in own if r["tokens"]} == want and own[0]["doc_tokens"] == len(ids)


def test_crossing_rules():
    sizes, bounds = np.array([3, 4, 2]), np.array([0, 5, 9])
    take = lambda rule: [x.tolist() for x in token_counts.attribute(sizes, bounds, rule)]
    assert take("start") == [[2, 1], [1, 0]] and take("end") == [[1, 2], [1, 0]] and take("most") == [[2, 1], [1, 0]]


# Secrets --------------------------------------------------------------------------------------


def test_secrets_against_sql(spark):
    key, weak = "AKIA" + "ABCD1234" * 2, "abcdEFGH0123" * 3 + "wxyz"
    texts = [
        'é password: "hunter22" and Token=abc', "api_key='abcdef123' APIKEY = zzzzzz", key + " " + key[:12], "0123456789abcdef" * 3 + " deadbeefdeadbeef", f"{key} then {weak} at https://s3.example.com/x",
        f"{weak} alone https://s3.example.com", f"{key}" + " x" * 300 + weak, 'secret=token": "abcdefgh"', "secret_token=password=abcdefgh;", f"ASIA{'Q' * 16} secret: s3cr3t-value", "x" * 50_000 + f" {key} " + "y" * 50_000,
    ]
    docs = documents(spark, list(enumerate(texts)) + ODD)
    out = secrets.find_secrets(docs)
    same(out, sql_rows(docs, oracles.secret_sql()))
    got = {r["doc_id"]: r for r in out.collect()}
    assert "weak_secret" in got[4]["spans"] and "endpoint" in got[4]["spans"]
    assert not any(w in got[i]["spans"] for i in (5, 6) for w in ("weak", "endpoint"))
    plan = secrets.base_spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_redaction(spark):
    docs = documents(spark, [(1, 'a password="hunter22" b'), (2, "clean"), (3, None), (4, "token=deadbeefdeadbeefdeadbeef")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.redact(docs).collect()}
    assert got == {1: ('a [secret]" b', 13), 2: ("clean", 5), 3: (None, 0), 4: ("[secret]", 8)}


def test_redaction_against_brute_force(spark):
    r = random.Random(4)
    parts = ['é password="hunter22x" ', "token=deadbeefdeadbeefdeadbeef1234 ", "AKIA" + "Q7" * 10 + " ", "plain wörds ", "0123456789abcdef" * 2 + " ", "x" * 700 + " ", "ASIA" + "Z" * 16 + " "]
    texts = ["".join(r.choices(parts, k=k)) for k in (1, 3, 10, 60, 400)] + ["token=" + "a" * 9000, "", None]
    docs = documents(spark, list(enumerate(texts)))
    spans = {s["doc_id"]: s["spans"] for s in secrets.find_secrets(docs).collect()}
    got = {x["doc_id"]: x["text"] for x in secrets.redact(docs, mark="<it's \\ gone>").collect()}
    for i, t in enumerate(texts):
        cuts = sorted((int(a), int(b)) for a, b in (s.split(":")[1:] for s in spans[i].split(",") if s))
        out, at = "", 0
        for a, b in cuts:
            if a >= at:
                out += t[at:a] + "<it's \\ gone>"
            at = max(at, b)
        assert got[i] == (out + t[at:] if t is not None else None)


def test_weak_parts_link_without_a_base_span(spark):
    key, bare = "ASIA" + "Q" * 16, "abcdEFGH0123" * 3 + "wxyz"
    docs = documents(spark, [(1, f"id {key} then {bare} end"), (2, f"id {key} alone"), (3, f"{bare} alone https://s3.example.com"), (4, key + " x" * 300 + " " + bare), (5, f"{bare} {key}")])
    got = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["spans"]) for r in secrets.find_secrets(docs).collect()}
    same(secrets.find_secrets(docs), sql_rows(docs, oracles.secret_sql()))
    assert got == {1: (0, 0, 0, "weak_access:3:23"), 2: (0, 0, 0, ""), 3: (0, 0, 0, ""), 4: (0, 0, 0, ""), 5: (0, 0, 0, "weak_access:41:61")}
    assert {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect() if "[secret]" in r["text"]} == {1: f"id [secret] then {bare} end", 5: f"{bare} [secret]"}


# WARC --------------------------------------------------------------------------------------------


def test_archives_against_sql(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 7)
    html = ["<p>é</p>", "", "x\r\n\r\nWARC/1.1\r\n", "<p>é</p>", None, "end\r\n\r\n", "big " * 60_000]
    rows = [(i, f"http://{'ABC'[i % 3]}.Example.org:80/p{i % 5}?q={i % 2}#f" if i % 9 else None, html[i % len(html)], "w") for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(4)
    out = warc.archive_and_index(pages)
    same(out, sql_rows(pages, oracles.WARC, "pages"))
    small = warc.archive_and_index(pages, least_bytes=1000).toPandas()
    assert set(small[small["record_type"] == "revisit"]["payload_bytes"]) == {240_000}
    assert warc.archive_and_index(pages.limit(0)).count() == 0


def test_pages_of_odd_ids_and_columns(spark):
    rows = [(-1, "http://a.org", "x", "noon", "k"), (2**62, "http://a.org", "x", None, "k"), (None, "http://b.org", "x", "2020-01-02 03:04:05", "k"), (None, None, "alone", None, "k"), (-7, "u", "alone", None, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, timestamp string, range string")
    out = warc.archive_and_index(pages)
    same(out, sql_rows(pages, oracles.WARC, "pages"))
    got = {(r["page_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in out.collect()}
    assert got == {(-1, 1): ("revisit", 2**62), (2**62, 1): ("response", None), (None, 1): ("revisit", 2**62), (None, 5): ("revisit", -7), (-7, 5): ("response", None)}
    dated = {r["stamp"] for r in warc.archive_and_index(pages, captured="timestamp").collect()}
    assert "2020-01-02T03:04:05Z" in dated and len(dated) == 5


def test_archives_of_one_member_a_record(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org", "é" * (i * 1000)) for i in range(40)], "page_id long, url string, html string")
    whole = [r["record"] + warc.END for r in warc.records(pages).collect()]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x.encode()) for x in whole[:25]))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress("".join(whole[25:]).encode()))
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r["page_id"] for r in got) == list(range(40)) and {r["payload_bytes"] for r in got} == {2000 * i for i in range(40)}
    own = [r["offset"] for r in sorted(got, key=lambda r: r["offset"]) if r["archive"] == "a.warc.gz"]
    assert own == [sum(len(x.encode()) for x in whole[:i]) for i in range(25)]
    with pytest.raises(ValueError):
        list(warc.inflated(gzip.compress(b"x" * 5000)[:-9]))


FOREIGN = (
    ("warcinfo", {"Content-Type": "application/warc-fields"}, b"software: other\r\n"),
    ("request", {"WARC-Target-URI": "http://Q.example.org/a"}, b"GET /a HTTP/1.1\r\n\r\n"),
    ("response", {"WARC-Target-URI": "<http://Q.example.org/a>"}, b"HTTP/1.1 200 OK\r\ncontent-length: 5\r\n\r\nhello"),
    ("metadata", {}, b""),
    ("response", {"WARC-Target-URI": "dns:example.org", "WARC-Payload-Digest": "md5:abc"}, b"20200101 example.org. A 1.2.3.4\r\n\r\nmore"),
    ("revisit", {"WARC-Target-URI": "http://q.example.org/a", "WARC-Refers-To": "<urn:uuid:1>", "WARC-Payload-Digest": "sha1:VL2MMHO4YXUKFWV63YHTWSBM3GXKSQ2N"}, b"HTTP/1.1 304 Not\r\n Modified\r\nContent-Length: 5\r\n\r\n"),
    ("revisit", {"WARC-Target-URI": "http://z.example.org/"}, b""),
)


def foreign_archive(lower):
    out = b""
    for i, (kind, head, block) in enumerate(FOREIGN):
        every = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{i}>", "WARC-Date": f"2020-01-0{i + 1}T00:00:00Z", **head, "Content-Length": str(len(block))}
        lines = [f"{k.lower()}:{v}" if lower else f"{k}: {v}" for k, v in every.items()]
        out += "\r\n".join(["WARC/1.0", *lines]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return out


@pytest.mark.parametrize("lower", [False, True])
def test_archives_made_elsewhere(spark, tmp_path, lower):
    import gzip

    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(foreign_archive(lower)))
    (tmp_path / "b.warc").write_bytes(foreign_archive(lower))
    (tmp_path / "notes.txt").write_text("no archive")
    got = warc.merged_index(warc.read_warc(spark, str(tmp_path))).orderBy("position").collect()
    hello = "VL2MMHO4YXUKFWV63YHTWSBM3GXKSQ2N"
    want = [
        (")example.org", "2020-01-05T00:00:00Z", None, 39, "response"), ("org,example,q)/a", "2020-01-03T00:00:00Z", None, 5, "response"),
        ("org,example,q)/a", "2020-01-06T00:00:00Z", None, 5, "revisit"), ("org,example,z)/", "2020-01-07T00:00:00Z", None, None, "revisit"),
    ]
    assert [(r["url_key"], r["stamp"], r["page_id"], r["payload_bytes"], r["record_type"]) for r in got] == [w for w in want for _ in range(2)]
    assert [r["payload_digest"] for r in got[2:6]] == [hello] * 4 and got[6]["payload_digest"] is None and [r["archive"] for r in got[:2]] == ["a.warc.gz", "b.warc"]


def test_equal_captures_are_dealt_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE", 40)
    monkeypatch.setattr(warc, "RUN_ROWS", 300)
    rows = [(None, None, "same")] * 2000 + [(i, f"http://h{i % 4}.org/{i % 3}", f"t{i % 11}") for i in range(300)]
    path = warc.fresh_path(spark, "t")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7), path)
    out = warc.merged_index(warc.read_warc(spark, path), range_rows=200)
    got = out.orderBy("position").collect()
    keys = [warc.order_key(*(r[c] for c in warc.ORDER)) for r in got]
    assert keys == sorted(keys) and len(set(keys)) == 2300 and [r["position"] for r in got] == list(range(2300))
    # Equal keys alone would leave one range with 2000 rows; archive and offset tell them apart, so cuts fall among them.
    assert len({k[:3] for k in keys}) < 310
    runs = {}
    for r in got:
        runs.setdefault(r["run"], []).append(r["nth"])
    assert all(sorted(x) == list(range(len(x))) for x in runs.values()) and max(map(len, runs.values())) > 250


def test_archives_of_long_pages_hold_fewer(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    warc.write_warc(spark.createDataFrame([(i, "u", "x" * 9500) for i in range(20)], "page_id long, url string, html string").coalesce(1), f"{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("*.gz"))) == 4


def test_loser_tree():
    r = random.Random(6)
    for k in range(1, 9):
        runs = [sorted(r.choices(range(50), k=r.randrange(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(sum(runs, []))
    assert list(warc.LoserTree([])) == []


def test_many_ranges_give_one_order(spark, monkeypatch):
    rows = [(i, f"http://h{i % 4}.org/{i % 3}", f"t{i % 11}") for i in range(300)]
    path = warc.fresh_path(spark, "t")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    got = warc.merged_index(warc.read_warc(spark, path), range_rows=20).orderBy("position").collect()
    keys = [(r["url_key"], r["stamp"], r["page_id"]) for r in got]
    assert keys == sorted(keys) and [r["position"] for r in got] == list(range(300))


# Packing --------------------------------------------------------------------------------------------


def test_tokens_equal_the_tokenizers(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    texts = [*prose(8, 80), "H̱e Á Thor,### <|ENDOFTEXT|> x.<|endoftext|>, y", "É. Él! it's, 12.5. a|b ΑΣ. ×. \x1c x\x1cy.\n\nA.\r\n", "İ. K. ﬁ. Ǆ. 2². ½.", "", "word " * 5000]
    own = packing.tokenizer(packing.default_tokenizer())
    ids, size = own.encode(pa.array(["Before É. " * 50, *texts, "cut off"], pa.large_string()).slice(1, len(texts)))
    ends = np.cumsum(size)
    for t, n, end in zip(texts, size, ends, strict=True):
        assert ids[end - n : end].tolist() == tok.encode(t, add_special_tokens=False).ids
    assert ends[-1] == len(ids)


def test_pieces_are_an_exact_partition(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    rows = [(i, t) for i, t in enumerate(prose(9, 300))] + [x for x in ODD if x[0]] * 1
    got = packing.pack_documents(documents(spark, rows), with_ids=True).toPandas()
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t)
    for d, ts in texts.items():
        own = got[got["doc_id"] == d]
        ids = tok.encode(ts[0] or "", add_special_tokens=False).ids + [1]
        assert (own["doc_tokens"] == len(ids)).all() and own["length"].sum() == len(ids) * len(ts)
        for _, p in own.iterrows():
            assert list(p["ids"]) == ids[p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["length"].sum() <= 2048 and (s["offset"].to_numpy() == np.concatenate(([0], s["length"].cumsum()[:-1]))).all()
    assert packing.pack_documents(documents(spark, [])).count() == 0


def padding(n, capacity):
    return 0 if n & (n - 1) == 0 else capacity - n


@pytest.mark.parametrize("capacity", [1, 2, 4, 8, 12, 20])
def test_cuts_against_brute_force(capacity):
    r = np.random.default_rng(4)
    for _ in range(30):
        ids = r.integers(0, 3, r.integers(1, 90))
        ends = np.unique(np.append(r.integers(1, len(ids) + 1, 3), len(ids)))
        at, pen = packing.candidates(ids, ends, np.array([False, True, False, False]), capacity)
        assert np.diff(at).max() <= max(capacity, 1)
        cost = {0: 0.0}
        for j in range(1, len(at)):
            gaps = {i: int(at[j] - at[i]) for i in range(j) if at[j] - at[i] <= capacity}
            cost[j] = min(cost[i] + pen[j] + packing.WINDOW + padding(n, capacity) for i, n in gaps.items())
        cuts = packing.best_cuts(at, pen, capacity)
        own = sum(pen[np.searchsorted(at, c)] + packing.WINDOW + padding(c - p, capacity) for p, c in zip([0, *cuts], cuts, strict=False))
        assert np.isclose(own, cost[len(at) - 1]) and cuts[-1] == len(ids) and max(np.diff([0, *cuts])) <= capacity


def test_capacity_is_checked(spark):
    with pytest.raises(ValueError):
        packing.pack_documents(documents(spark, [(1, "a")]), capacity=0)
    with pytest.raises(ValueError):
        packing.best_cuts(np.array([0, 1]), np.zeros(2), 0)


def test_stretches_join_without_loss():
    docs = [(i, np.arange(n, dtype=np.uint32)) for i, n in enumerate([5, 5000, 1, 1, 3000, 700])]
    parts = [(pa.array([d]), np.zeros(1, np.int64), np.array([len(x)]), np.array([len(x)]), x) for d, x in docs]
    got, sequences, tails = {}, {}, 0
    for stream, cuts, first in packing.pack_stream(iter(parts), np.zeros(10, bool), 256, 1024):
        tails += not cuts
        cols, begin, stop = packing.pieces(stream, cuts or [len(stream[4])], first)
        for k in range(len(begin)):
            ids = stream[4][begin[k] : stop[k]]
            assert cols[1][k] == ids[0] and cols[2][k] == len(ids) and cols[3][k] == zlib.crc32(ids.tobytes()) and cols[6][k] == sequences.get(cols[5][k], 0)
            got.setdefault(cols[0][k].as_py(), []).append(ids)
            sequences[cols[5][k]] = sequences.get(cols[5][k], 0) + len(ids)
    for d, ids in docs:
        assert np.concatenate(got[d]).tolist() == ids.tolist()
        assert cuts or tails == 1
    assert tails == 1 and max(sequences.values()) <= 256 and sorted(sequences) == list(range(len(sequences)))


def test_padding_does_not_grow_with_partitions(spark):
    rows = [(i, t) for i, t in enumerate(prose(12, 4000))]
    for parts in (1, 4, 211):
        docs = spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string").repartition(parts)
        got = packing.pack_documents(docs).toPandas()
        size = got.groupby("sequence_id")["length"].sum()
        tokens = size.sum()
        padded = sum(padding(int(n), 2048) for n in size)
        assert tokens > 250_000 and padded < 0.02 * tokens, (parts, padded / tokens)
        assert len(size) < 1.1 * tokens / 2048
        per = got.groupby("doc_id").agg(n=("length", "sum"), total=("doc_tokens", "first"))
        assert (per["n"] == per["total"]).all() and len(per) == len(rows)


# Columns that clash ------------------------------------------------------------------------------------


def test_columns_that_clash_stay(spark):
    from spotweave.llm.ngram_join import one_of_each

    extra = ["_rows", "_text", "_copy", "timestamp", "Shard_", "spotweave_rows", "spotweave_text", "spotweave_copy", "spotweave_crc", "tid", "kept", "a.b"]
    rows = [(1, "one two three token=abcdefgh", "s", 5, *["x"] * len(extra)), (2, "four five six", "s", 5, *["y"] * len(extra)), (2, "four five six", "s", 5, *["z"] * len(extra)), (None, None, None, None, *["n"] * len(extra))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra))
    for stage in (one_of_each, secrets.redact, mixing.mixed_documents):
        out = stage(docs)
        assert out.columns == docs.columns, stage
        assert {r["_rows"] for r in out.collect()} <= {"x", "y", "z", "n"}
    assert secrets.redact(docs).where("doc_id = 1").first()["text"] == "one two three [secret]"
    assert packing.pack_documents(docs).count() == 4
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.keep_good(docs, labels).count() == 4
    sharding.write_shards(docs, warc.fresh_path(spark, "clash"), 2)


# Pipeline ----------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(3)
    vocab = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(400):
        w = r.choices(vocab, k=60)
        if i % 8 == 1:
            w = [x.removesuffix("%%%").removesuffix("token=abcdefgh1234") for x in rows[-1][1].split()[:59]] + ["other"]
        bad = i % 5 == 4
        rows.append((i, " ".join(x + "%%%" for x in w) if bad else " ".join(w) + (" token=abcdefgh1234" if i % 10 == 0 else "")))
        labels.append((i, 0 if bad else 1))
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen, given = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        given[name] = docs
        docs = stage(spark, docs, d).cache()
        seen[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    bad = {i for i, y in labels if not y}
    assert not bad & {x["doc_id"] for x in seen["quality"].collect()}
    from test_ngram_join import brute

    kept = sorted((x["doc_id"], x["text"]) for x in seen["quality"].collect())
    assert {x["doc_id"] for x in seen["near_duplicates"].collect()} == {c for _, _, c in brute(kept)}
    assert not any(re.search("token=", x["text"]) for x in seen["secrets"].collect())
    # Each stage against what it was given, by plain Python or the operator's own decisions.
    table = lambda x: sorted((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in x.collect())
    scores = {r["doc_id"]: r["predicted"] for r in quality.score_documents(given["quality"], spark.read.parquet(f"{d}/labels.parquet")).collect()}
    assert table(seen["quality"]) == [r for r in table(given["quality"]) if scores[r[0]]]
    mark = lambda t: re.sub(r"token=[a-z0-9]{6,}", "[secret]", t)
    assert table(seen["secrets"]) == [(i, mark(t), a, b, len(mark(t))) for i, t, a, b, _ in table(given["secrets"])]
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_sources(given["mixing"]).collect()}
    assert table(seen["mixing"]) == sorted(r for r in table(given["mixing"]) for _ in range(times[r[0]]))
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    want, got = {}, {}
    for i, t, *_ in table(given["packing"]):
        want.setdefault(i, []).append(len(tok.encode(t, add_special_tokens=False).ids) + 1)
    for p in seen["packing"].collect():
        got.setdefault(p["doc_id"], []).append(p)
    assert set(got) == set(want)
    for i, n in want.items():
        covered = sorted(x for p in got[i] for x in range(p["start"], p["start"] + p["length"]))
        assert covered == sorted(x for k in n for x in range(k)) and {p["doc_tokens"] for p in got[i]} == set(n)


def test_secrets_in_a_text_of_many_blocks(spark):
    import re

    n = 3 * secrets.BLOCK + 7
    text = "".join(f"é password=abcdef{i} https://x.y " for i in range(n))
    want = ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer(r"password=[a-z0-9]+", text))
    row = secrets.find_secrets(documents(spark, [(1, text)])).first()
    assert row["n_assign"] == n and row["spans"] == want


def test_the_table_of_words_forgets_and_finds():
    r = np.random.default_rng(6)
    table = packing.WordTable(10)
    seen = {}
    for _ in range(40):
        one = np.unique(r.integers(1, 2**64, 90, dtype=np.uint64))
        one[: len(one) // 2] &= np.uint64((1 << 54) - 1)  # many want the same slots
        one = np.unique(one)
        two, ids = one * np.uint64(3), [np.arange(int(h % np.uint64(5)), dtype=np.uint32) + np.uint32(h % np.uint64(1000)) for h in one]
        table.add(one, two, ids)
        seen |= {int(h): x.tolist() for h, x in zip(one, ids, strict=True)}
        at = table.slots(one)
        assert (table.hash[at] == one).all() and (table.check[at] == two).all() and table.held == np.count_nonzero(table.hash) <= 512
        held = np.flatnonzero(table.hash)
        assert len(set(table.hash[held].tolist())) == len(held) and (table.slots(table.hash[held]) == held).all()
        for s in held:
            assert table.flat[table.start[s] : table.start[s] + table.size[s]].tolist() == seen[int(table.hash[s])]
