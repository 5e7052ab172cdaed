import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from spotweave.llm import periodic_runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(t, least, times):
    """Every run by comparing all places at all distances."""
    n, out = len(t), []
    for p in range(1, n // max(times, 1) + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and t[i] == t[i + p]:
                i += 1
            length = i + p - start
            whole = t[start : start + length]
            if i > start and length >= max(least, times * p) and not any(whole[q:] == whole[:-q] for q in range(1, p)):
                out.append((start, length, p))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def contract(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words, 24, 3)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *top, *[hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)])


def fixture():
    r = random.Random(3)
    rows = []
    for i in range(240):
        few = r.choices(["a", "b", "é", "Word", " x", "don't"], k=r.choice([1, 2, 3, 6]))
        words = r.choices(few, k=r.choice([0, 1, 5, 40, 150]))
        for _ in range(r.choice([0, 1, 2])):
            at, piece = r.randrange(len(words) + 1), r.choices(few, k=r.randrange(1, 9))
            words[at:at] = piece * r.randrange(2, 9)
        rows.append((i, r.choice([" ", "\n", " \t\x0b", "\x0c\r "]).join(words) + r.choice(["", " ", "\n"])))
    odd = [(None, "x " * 30), (None, None), (500, None), (500, "y " * 24), (501, ""), (502, " \n"), (503, "y " * 23), (504, "same text"), (504, "same text"), (-3, "z z " * 40), (505, "a\x00b " * 25), (506, ("p q r " * 2000) + "end")]
    return rows + odd


def frame(spark, rows):
    full = [(d, t, 1, "r") for d, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, n_runs long, runs string").repartition(3)


def test_contract_rows_against_brute_force(spark):
    got = [tuple(r) for r in periodic_runs.run_digests(frame(spark, fixture())).collect()]
    want = [contract(*r) for r in fixture()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 40 and sum(r[1] > 1 for r in want) > 5


def test_runs_and_collapsed_texts(spark):
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(frame(spark, [(1, "start " + "a b c " * 10 + "end"), (2, "a b c d"), (3, None)])).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 30, 3)] and got[1]["text"] == "start a b c end"
    assert got[2]["runs"] == [] and got[2]["text"] == "a b c d" and got[3]["text"] == ""


@pytest.mark.parametrize(("least", "times"), [(2, 2), (3, 3), (6, 2), (10, 4), (24, 3)])
def test_runs_against_brute_force(least, times):
    r = random.Random(least)
    total = 0
    for _ in range(600):
        t = [r.randrange(r.choice([1, 2, 3, 4])) for _ in range(r.randrange(60))]
        if t and r.random() < 0.6:
            a, p = r.randrange(len(t)), r.randrange(1, 9)
            t = t[:a] + [t[min(a + (i - a) % p, len(t) - 1)] for i in range(a, len(t))]
        want = brute(t, least, times)
        assert periodic_runs.runs(t, least, times) == want
        rows = [t[: len(t) // 2], t, [], t[::-1]]
        words = [[b"%d" % x for x in row] for row in rows]
        assert periodic_runs.runs_of(words, least, times) == [brute(row, least, times) for row in rows]
        total += len(want)
    assert total > 20


def test_words_compared_stay_linear():
    last, fibonacci = [0], [0, 1]
    while len(fibonacci) < 5000:
        last, fibonacci = fibonacci, fibonacci + last
    inputs = [[0] * 5000, [0, 1] * 2500, fibonacci, [bin(i).count("1") & 1 for i in range(5000)], [(i & -i).bit_length() for i in range(1, 5000)], ([0, 1] * 30 + [2]) * 80, list(range(5000))]
    inputs += [sum(([0, 1] * k + [2] for k in range(70)), []), sum(([0] * k + [1] for k in range(100, 0, -1)), [])]
    for t in inputs:
        for ranks in (t, [-x for x in t]):
            assert periodic_runs.lyndon(ranks)[2] <= 3 * len(t)


def test_next_smaller_suffixes_against_brute_force():
    r = random.Random(9)
    for _ in range(300):
        t = [r.randrange(3) for _ in range(r.randrange(40))]
        following, agree, _ = periodic_runs.lyndon(t)
        for i in range(len(t)):
            j = next((j for j in range(i + 1, len(t)) if t[j:] < t[i:]), len(t))
            same = next((k for k in range(len(t)) if j + k >= len(t) or t[i + k] != t[j + k]), 0)
            assert (following[i], agree[i]) == (j, same if j < len(t) else 0)


def test_many_distinct_words():
    words = [b"%d" % i for i in range(60_000)] + [b"a", b"b"] * 20 + [b"%d" % i for i in range(60_000)]
    assert periodic_runs.runs_of([words])[0] == [(60_000, 40, 2)]


def test_empty_table(spark):
    assert periodic_runs.run_digests(frame(spark, fixture()).where(F.lit(False))).collect() == []
