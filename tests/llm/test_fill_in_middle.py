import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from spotweave.llm import fill_in_middle, oracles

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)
COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    hashed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hashed[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, len(units), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}", text


def fixture():
    r = random.Random(5)
    bits = ["word", "é", "\n", " ", "<", "<S", ">", "P>", "x1", "🙂", "\t", "\x00", "'", '"', "{}", "\\", "\r\n"]
    rows = [(i, "".join(r.choices(bits, k=r.choice([0, 1, 2, 9, 60])))) for i in range(300)]
    odd = [(-7, "negative id"), (2**62, "a large id"), (900, None), (901, ""), (902, "has <P> in it"), (903, "<M>"), (904, "same"), (904, "same"), (904, "other"), (None, "no id"), (None, None), (905, "Zé " * 100_000)]
    return rows + odd


def frame(spark, rows):
    full = [(d, t, "o", "f", 1, None) for d, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, output string, form string, n long, units string").repartition(3)


def key(rows):
    return sorted(rows, key=repr)


def test_every_row_against_plain_python(spark):
    docs = frame(spark, fixture())
    got = [tuple(r) for r in fill_in_middle.fill_in_middle(docs).collect()]
    assert key(got) == key([plain(*r)[:6] for r in fixture()])
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_outputs_are_taken_apart_again(spark):
    docs = frame(spark, fixture())
    back = fill_in_middle.restore(fill_in_middle.fill_in_middle(docs)).select("doc_id", "restored").collect()
    assert key([tuple(r) for r in back]) == key([(d, t or "") for d, t in fixture()])


def test_digests_against_sql(spark):
    docs = frame(spark, fixture())
    con = duckdb.connect()
    documents = docs.toArrow()  # noqa: F841 (read by the SQL)
    want = con.execute(f"select {', '.join(COLUMNS)} from ({oracles.FIM})").fetchall()
    got = [tuple(r) for r in fill_in_middle.digests(docs).select(*COLUMNS).collect()]
    assert key(got) == key(want)
    hashed = [(*r[:5], *[hashlib.sha256(x.encode()).hexdigest() for x in r[5:]]) for r in (plain(*x) for x in fixture())]
    assert key(got) == key(hashed)


def test_empty_table(spark):
    assert fill_in_middle.digests(frame(spark, fixture()).where(F.lit(False))).collect() == []
