"""Components, tissues and directional clusters against plain Python."""

import os
import random

import pytest

from spotweave import quant_queries, queries
from spotweave.operators import graphs, spatial
from spotweave.operators import umis as um

SMALL = "/root/testdata/sf0.001"


def plain_components(edges):
    low = {x: x for e in edges if e[0] != e[1] for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return low


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 180)] + [(9, i) for i in range(300, 360)] + [(r.randrange(500, 700), r.randrange(500, 700)) for _ in range(140)] + [(4, 4), (180, 9), (9, 180)]
    got = {x["node"]: x["component"] for x in graphs.components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    assert got == plain_components(edges) and 4 not in got
    words = [(f"n{a}", f"n{b}") for a, b in edges]
    assert {x["node"]: x["component"] for x in graphs.components(spark.createDataFrame(words, "u string, v string")).collect()} == plain_components(words)
    assert graphs.components(spark.createDataFrame([], "u long, v long")).collect() == []


def plain_tissues(points, distance):
    """{(section, cell): tissue}; points are (section, cell, x, y)."""
    out = {}
    for section in {p[0] for p in points}:
        own = [p for p in points if p[0] == section]
        edges = [(a[1], b[1]) for a in own for b in own if a[1] < b[1] and ((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2) ** 0.5 < distance]
        low = plain_components(edges)
        out |= {(section, c): low.get(c, c) for _, c, *_ in own}
    return out


def test_tissues_of_blobs(spark):
    r = random.Random(5)
    points = [(s, i, x + r.random() * 3, y + r.random() * 3) for s in ("a", "b") for i, (x, y) in enumerate([(0, 0)] * 40 + [(10, 0)] * 30 + [(0, 9)] * 20 + [(50, 50)])]
    df = spark.createDataFrame(points, "section string, cell long, x double, y double").repartition(3)
    got = {(r["section"], r["cell"]): r["tissue"] for r in spatial.tissue_components(df, 1.2, section="section").collect()}
    assert got == plain_tissues(points, 1.2) and len(set(got.values())) >= 4
    alone = spatial.tissue_components(df.where("section = 'a'").drop("section"), 1.2)
    assert alone.columns == ["cell", "x", "y", "tissue"] and {r["cell"]: r["tissue"] for r in alone.collect()} == {c: t for (s, c), t in got.items() if s == "a"}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
def test_every_row_of_the_query(spark):
    points = [(r["cell"] % 8, r["cell"], r["x"], r["y"]) for r in queries._points(spark, SMALL).collect()]
    want = plain_tissues(points, 0.05)
    got = {(r["section"], r["cell"]): r["tissue"] for r in quant_queries.tissue_components(spark, SMALL).collect()}
    assert got == want and len(set(want.values())) < len(want)


def plain_clusters(counts):
    """Number of clusters of {umi: n}, followed from the most counted."""
    seen, groups = set(), 0
    for u in sorted(counts, key=lambda u: (-counts[u], u)):
        if u in seen:
            continue
        groups += 1
        seen.add(u)
        queue = [u]
        while queue:
            a = queue.pop()
            for b in counts:
                if b not in seen and len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1 and counts[a] >= 2 * counts[b] - 1:
                    seen.add(b)
                    queue.append(b)
    return groups


def test_directional_clusters(spark):
    r = random.Random(11)
    rows = []
    for cell, gene in [("a", "p"), ("a", "q"), ("b", None), (None, "p"), ("c", "p")]:
        for _ in range(r.choice([3, 40, 60])):
            rows += [(cell, gene, "".join(r.choices("ACG", k=4)))] * r.choice([1, 1, 1, 2, 5, 9])
    rows += [("d", "one", "ACGT"), ("d", "one", "ACG"), ("d", "one", None), ("e", "none", None)]
    df = spark.createDataFrame(rows, "cell string, gene string, umi string").repartition(4)
    groups = {}
    for c, g, u in rows:
        if u is not None:
            own = groups.setdefault((c, g), {})
            own[u] = own.get(u, 0) + 1
    got = {(x["cell"], x["gene"]): x["n"] for x in um.count_directional(df).collect()}
    assert got == {k: plain_clusters(v) for k, v in groups.items()}
