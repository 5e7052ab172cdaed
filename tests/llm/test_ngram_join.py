import random
import re

from spotweave.llm import common, ngram_join
from spotweave.llm import text as tx
from spotweave.llm.ngram_join import ngram_jaccard_join, need


def brute(rows, n=5, num=80, den=100):
    sets = []
    for _, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    comp = list(range(len(rows)))

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and den * same >= num * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(d, low.get(find(i), d))
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


def got(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, n string, cls int")
    return sorted(map(tuple, ngram_jaccard_join(df.repartition(5), **kw).collect()))


def corpus(seed, groups=25):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    license_line = " ".join(r.choices(vocab, k=60))
    rows = []
    for _ in range(groups):
        base = r.choices(vocab, k=r.choice([1, 3, 5, 6, 9, 12, 20, 40, 80, 150, 400]))
        for _ in range(r.choice([1, 2, 5, 9])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4, 8])):
                if len(w) > 1:
                    k = r.randrange(len(w))
                    w[k : k + r.choice([0, 1])] = [r.choice(vocab)] * r.choice([0, 1])
            t = " ".join(w)
            if r.random() < 0.3:
                t = t + "\n" + license_line
            rows.append(r.choice([t, t.upper(), t.replace(" ", "\t")]))
    return [(i, t) for i, t in enumerate(r.sample(rows, len(rows)))]


def test_against_brute_force(spark):
    rows = corpus(1) + [(9001, None), (9002, ""), (9003, " \n\t"), (9004, None), (9005, "É é"), (9006, "é é"), (9007, "É é")]
    assert got(spark, rows) == brute(rows)


def test_hot_group_of_near_copies_and_ties(spark):
    r = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3])):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(i, t) for i, t in rows[:10]]  # repeated rows
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_need_is_the_jaccard_bound():
    for n in range(1, 40):
        for m in range(1, 40):
            least = next((o for o in range(min(n, m) + 1) if 100 * o >= 80 * (n + m - o)), min(n, m) + 1)
            assert need(n, m, 80, 100) >= least or least == need(n, m, 80, 100)
            assert min(need(n, m, 80, 100), min(n, m) + 1) == least


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    import numpy as np

    data = np.frombuffer(("alpha beta gamma " * 200).encode(), np.uint8)
    off = np.array([0, 17 * 100, len(data)])
    a = tx.word_hashes(data, off)
    monkeypatch.setattr(tx, "PIECE", 100)
    b = tx.word_hashes(data, off)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and len(set(a[0].tolist())) == 3


def test_lists_dealt_over_parts_lose_no_one(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 3)
    monkeypatch.setattr(ngram_join, "SEEN", 1)
    seen, made = [], ngram_join.dealt_postings
    monkeypatch.setattr(ngram_join, "dealt_postings", lambda *a: seen.append(made(*a)) or seen[-1])
    rows = []
    for g in range(30):
        w = [f"g{g}x{i}" for i in range(60)]
        rows += [(100 * g + i, " ".join(w)) for i in range(4)] + [(100 * g + 9 + i, " ".join(w[:-1] + [f"other{i}"])) for i in range(6)]
    assert got(spark, rows) == brute(rows)
    longest = seen[0].groupBy("key", "deal").count().agg({"count": "max"}).first()[0]
    assert seen[0].where("shiftright(deal, 32) > 1").count() and longest < seen[0].groupBy("key").count().agg({"count": "max"}).first()[0]
    rows = corpus(2)
    assert got(spark, rows) == brute(rows)


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(common, "HUB", 20)
    r = random.Random(4)
    edges = [(7, i) for i in range(100, 400)] + [(399, 500), (500, 3), (1000, 1001)] + [(r.randrange(2000, 2200), r.randrange(2000, 2200)) for _ in range(150)]
    got = {x["node"]: x["component"] for x in common.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    low = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(len(low)):
        before = dict(low)
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    assert got == low and low[100] == 3


def test_classes_of_one_hash_stay_apart(spark):
    rows = corpus(5, groups=12)
    assert got(spark, rows, class_bits=3) == brute(rows)


def test_crowded_classes_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "DEAL", 4)
    r = random.Random(7)
    base = [f"c{i}" for i in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        w[r.randrange(len(w))] = f"y{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + d, t) for d, t in corpus(6, groups=6)]
    assert got(spark, rows) == brute(rows)


def test_rows_without_an_id_link_by_their_text(spark):
    w = [f"v{i}" for i in range(60)]
    text, near = " ".join(w), " ".join(w[:-1] + ["other"])
    lone = [" ".join(f"{k}{i}" for i in range(60)) for k in "pq"]
    rows = [(None, text), (7, text), (8, text), (9, near)]
    rows += [(None, lone[0]), (None, lone[0]), (None, lone[0].upper()), (3, lone[0] + " more"), (None, lone[1]), (None, lone[1] + " more"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, ngram_jaccard_join(df).collect()), key=repr)
    want = [(None, 56, 7), (7, 56, 7), (8, 56, 7), (9, 56, 7), (None, 56, 3), (None, 56, 3), (None, 56, 3), (3, 57, 3), (None, 56, None), (None, 57, None), (None, 0, None)]
    assert found == sorted(want, key=repr)
    kept = sorted(map(tuple, ngram_join.one_of_each(df).collect()), key=repr)
    least = [[r for r in kept if r[0] is None and r[1]]]
    assert len(least[0]) == 1 and least[0][0][1] in (lone[1], lone[1] + " more")
    assert kept == sorted([(7, text), (3, lone[0] + " more"), (None, None), *least[0]], key=repr)


def test_rows_of_one_id_stay_by_their_own_text(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    rows = [(3, b, "x"), (5, a, "x"), (5, b + " more", "x"), (6, "c d e f g h", "z"), (6, "c d e f g h", "y"), (6, "other words stand in here", "x"), (7, "", "x"), (7, "", "x"), (7, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `_rows` string").repartition(3)
    want = [rows[0], rows[1], rows[4], rows[5], rows[6], rows[8]]
    assert sorted(map(tuple, ngram_join.one_of_each(df).collect()), key=repr) == sorted(want, key=repr)


def test_stage_against_brute_force(spark):
    rows = corpus(11)
    r = random.Random(2)
    rows = [(r.choice([d, d // 3, None]), t) for d, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = list(map(tuple, ngram_join.one_of_each(df).collect()))
    # With ids of their own, the rows' components are those of their texts.
    texts = sorted({t for _, t in rows if t is not None})
    group = {texts[i]: c for i, _, c in brute(list(enumerate(texts)))}
    empty = lambda t: not (t or "").split()
    want_groups = {}
    for d, t in rows:
        if not empty(t):
            want_groups.setdefault(group[t], []).append(d)
    got_groups = {}
    for d, t in kept:
        if not empty(t):
            assert (d, t) in rows
            got_groups.setdefault(group[t], []).append(d)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in want_groups.items()}
    assert got_groups == {g: [d] for g, d in least.items()}
    assert sorted([x for x in kept if empty(x[1])], key=repr) == sorted({x for x in rows if empty(x[1])}, key=repr)
