"""Secret scans with multipart credential linking, in native expressions only.

Base spans (kinds assign, access, hex) come from three patterns over whole
texts.  In texts that have any, or an access identifier of another form,
weaker parts are collected too: those identifiers, bare 40-character secrets,
short hex strings and endpoints.  An interval join within scopes (SCOPE code points, by bins) then
reports a weak part only when its complement is near:

* weak_access near a secret (assign, hex or weak_secret);
* weak_secret and weak_hex near an access identifier (access);
* endpoint near both an access identifier and a secret.

Edge cases: null text is empty; an empty text has no spans and the hash of the
empty string; repeated rows get equal results; very long texts are scanned
whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm.common import bounded, unused, written

#: Code points between two parts of one credential, at most.
SCOPE = 200

#: Fixed patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
WEAK_PREFIXES = ["ASIA", "AROA", "AIDA", "LTAI", "AIza"]
WEAK_ACCESS = f"(?:{'|'.join(WEAK_PREFIXES)})[A-Za-z0-9_-]{{12,40}}"
WEAK_SECRET = "[A-Za-z0-9+/]{40}"
WEAK_HEX = "[0-9a-f]{16,23}"
ENDPOINT = r"https?://[A-Za-z0-9.:-]+|[a-z0-9.-]+\.(?:amazonaws|internal|cloud)\.[a-z]{2,4}"
KINDS = ["assign", "access", "hex", "weak_access", "weak_secret", "weak_hex", "endpoint"]
SPAN = "array<struct<start:int,kind:int,stop:int>>"


#: Matches whose offsets are summed in one inner pass; it keeps the work on a text of many matches near linear.
BLOCK = 512


def spans(text: str, pattern: str, kind: str, least: str = "true") -> F.Column:
    """Array of (start, kind, stop) of the pattern's matches, leftmost and not overlapping; ``least`` filters on the match m.

    Splitting by the pattern gives the pieces between matches, so running lengths give the offsets.  The piece
    after the last match has no match beside it and goes.  Growing one array match by match would copy it each
    time, so blocks of matches grow arrays of their own, which are joined at the end.
    """
    p = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    k = KINDS.index(kind)
    one = "struct<start:int,kind:int,stop:int,m:string>"
    return F.expr(
        f"""filter(transform(array(arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0))), z ->
              aggregate(sequence(0, cast((size(z) - 1) / {BLOCK} as int)),
                named_struct('at', 0, 'done', cast(array() as array<array<{one}>>)),
                (acc, b) -> transform(array(aggregate(slice(z, b * {BLOCK} + 1, {BLOCK}),
                    named_struct('at', acc.at, 'out', cast(array() as array<{one}>)),
                    (own, x) -> named_struct(
                      'at', own.at + length(x['0']) + coalesce(length(x['1']), 0),
                      'out', concat(own.out, array(named_struct('start', own.at + length(x['0']), 'kind', {k}, 'stop', own.at + length(x['0']) + coalesce(length(x['1']), 0), 'm', x['1'])))))),
                  r -> named_struct('at', r.at, 'done', concat(acc.done, array(r.out))))[0],
                r -> flatten(r.done)))[0], y -> y.m is not null and {least.replace("{m}", "y.m")})"""
    )


def _plain(col: F.Column) -> F.Column:
    return F.transform(col, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))


def _shown(col: F.Column) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(F.array_sort(col), one), ",")


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with base and weak span arrays; weak ones only where a base span or a weak identifier can have them linked."""
    group2 = "length(regexp_extract({m}, '" + ASSIGN.replace("\\", "\\\\").replace("'", "\\'") + "', 2)) >= 6"
    none = F.expr(f"cast(array() as {SPAN})")
    t = F.col("text")
    has_assign = t.rlike(r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""")
    out = docs.withColumn(
        "base",
        F.concat(
            F.when(has_assign, _plain(spans("text", ASSIGN, "assign", group2))).otherwise(none),
            F.when(t.contains("AKIA"), _plain(spans("text", ACCESS, "access", "length({m}) >= 20"))).otherwise(none),
            # A run of 24 or more is the same match as a run of any length that is then kept for its length.
            F.when(t.rlike("[0-9a-f]{24}"), _plain(spans("text", "[0-9a-f]{24,}", "hex"))).otherwise(none),
        ),
    )
    weak = F.concat(
        _plain(spans("text", WEAK_ACCESS, "weak_access")),
        _plain(spans("text", WEAK_SECRET, "weak_secret")),
        _plain(spans("text", WEAK_HEX, "weak_hex")),
        _plain(spans("text", ENDPOINT, "endpoint")),
    )
    # Every link needs a base span or a weak_access; looking for bytes spares most texts the pattern.
    prefix = reduce(or_, [t.contains(p) for p in WEAK_PREFIXES])
    return out.withColumn("weak", F.when((F.size("base") > 0) | (prefix & t.rlike(WEAK_ACCESS)), weak).otherwise(none))


KEY = ["doc_id", "tid", "start", "kind", "stop"]


def _in_bins(parts: DataFrame, scope: int, slack: int = 0) -> DataFrame:
    """``parts`` once for each bin that they reach, with ``slack`` more bins on both sides."""
    last = ((F.col("stop") - 1) / scope).cast("int")
    return parts.withColumn("bin", F.explode(F.sequence((F.col("start") / scope).cast("int") - slack, last + slack)))


def _same_bin(a: str, b: str) -> F.Column:
    on = lambda c: F.col(f"{a}.{c}") == F.col(f"{b}.{c}")
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & on("tid") & on("bin")


def uncovered(weak: DataFrame, base: DataFrame, scope: int) -> DataFrame:
    """The weak parts that no base span overlaps: what a base span covers already is no part of its own."""
    a, b = _in_bins(weak, scope).alias("a"), _in_bins(base, scope).alias("b")
    over = (F.col("b.start") < F.col("a.stop")) & (F.col("a.start") < F.col("b.stop"))
    found = a.join(b, _same_bin("a", "b") & over, "left").groupBy(*[F.col(f"a.{c}") for c in KEY]).agg(F.count("b.start").alias("_n"))
    return found.where("_n = 0").select(*KEY)


def link_parts(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, tid, linked): weak parts with their complements in scope, by an equi-join on bins of the scope's width."""
    some = found.where("size(weak) > 0").select("doc_id", "tid", "base", "weak").dropDuplicates(["doc_id", "tid"])
    k = {name: i for i, name in enumerate(KINDS)}
    spread = lambda c: some.select("doc_id", "tid", F.explode(c).alias("p")).select("doc_id", "tid", "p.*").select(*KEY)
    base = spread("base")
    weak = written(uncovered(spread("weak"), base, scope), "weak-parts")
    role = F.when(F.col("kind") == k["access"], "id").when(F.col("kind").isin(k["assign"], k["hex"], k["weak_secret"]), "secret")
    strong = _in_bins(base.unionByName(weak).withColumn("role", role).where("role is not null"), scope, 1)
    strong = strong.select("doc_id", "tid", "bin", "role", F.col("start").alias("s_start"), F.col("stop").alias("s_stop"))
    a, b = weak.withColumn("bin", (F.col("start") / scope).cast("int")).alias("a"), strong.alias("b")
    # A long weak part ends in a later bin than it starts in, so its end has partners of its own.
    ends = weak.withColumn("bin", ((F.col("stop") - 1) / scope).cast("int")).where(F.col("bin") > (F.col("start") / scope).cast("int"))
    a = a.unionByName(ends).alias("a")
    near = (
        a.join(b, _same_bin("a", "b")
               & (F.col("b.s_start") <= F.col("a.stop") + scope) & (F.col("a.start") <= F.col("b.s_stop") + scope)
               & ((F.col("b.s_stop") <= F.col("a.start")) | (F.col("a.stop") <= F.col("b.s_start"))))
        .groupBy(*[F.col(f"a.{c}") for c in KEY])
        .agg(F.max(F.when(F.col("role") == "id", 1).otherwise(0)).alias("id"), F.max(F.when(F.col("role") == "secret", 1).otherwise(0)).alias("secret"))
    )
    whole = (
        ((F.col("kind") == k["weak_access"]) & (F.col("secret") == 1))
        | (F.col("kind").isin(k["weak_secret"], k["weak_hex"]) & (F.col("id") == 1))
        | ((F.col("kind") == k["endpoint"]) & (F.col("id") == 1) & (F.col("secret") == 1))
    )
    return near.where(whole).groupBy("doc_id", "tid").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("linked"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, tid, base, linked) for each row: the span arrays; tid is a hash of the text."""
    source = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = written(base_spans(source).select("doc_id", F.xxhash64("text").alias("tid"), "base", "weak"), "spans")
    links = written(link_parts(found, scope), "linked").select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), "linked")
    none = F.expr(f"cast(array() as {SPAN})")
    return found.join(bounded(links), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tid") == F.col("t")), "left").select(
        "doc_id", "tid", "base", F.coalesce("linked", none).alias("linked")
    )


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row of ``docs``."""
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return scan(docs, scope).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_shown(F.col("base")), 256).alias("base_sha256"),
        _shown(F.concat("base", "linked")).alias("spans"),
    )


#: Code points of the blocks that a text is cut into before spans are taken out, so that no cut walks a long text from its start.
CHUNK = 4096


def _between(a: str, b: str) -> str:
    """SQL for the text from a to b, from the array ``chunks`` of its blocks."""
    return f"""if({a} >= {b}, '', array_join(transform(sequence(cast({a} div {CHUNK} as int), cast(({b} - 1) div {CHUNK} as int)), k ->
        substring(get(chunks, k), cast(greatest({a} - k * {CHUNK}, 0) as int) + 1, cast(least({b} - k * {CHUNK}, {CHUNK}) - greatest({a} - k * {CHUNK}, 0) as int))), ''))"""


def redact(docs: DataFrame, mark: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by one) and, where there, n_chars counted anew.

    What stays of a text lies between spans that reach farther than all before them; it is cut from blocks of the text.
    """
    hits = scan(docs, scope).where("size(base) > 0 or size(linked) > 0").dropDuplicates(["doc_id", "tid"])
    spans_ = hits.select("doc_id", "tid", F.explode(F.concat("base", "linked")).alias("s")).select("doc_id", "tid", "s.start", "s.stop")
    before = Window.partitionBy("doc_id", "tid").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    reach = spans_.withColumn("from", F.coalesce(F.max("stop").over(before), F.lit(0)))
    kept = F.when(F.col("start") >= F.col("from"), F.struct("from", F.col("start").alias("to")))
    cuts = reach.groupBy("doc_id", "tid").agg(F.array_sort(F.collect_list(kept)).alias("kept"), F.max("stop").alias("rest"))
    cuts = bounded(written(cuts.select(F.col("doc_id").alias("cut_id"), "tid", "kept", "rest"), "cuts")).alias("h")
    d = docs.alias("d")
    on = F.col("d.doc_id").cast("long").eqNullSafe(F.col("h.cut_id")) & (F.xxhash64("d.text") == F.col("h.tid"))
    new = unused(docs, "text")
    joined = d.join(cuts, on, "left").select("d.*", F.col("h.kept").alias(f"{new}_kept"), F.col("h.rest").alias(f"{new}_rest"))
    said = mark.replace("\\", "\\\\").replace("'", "\\'")
    blocks = f"transform(array(regexp_extract_all(text, '(?s).{{1,{CHUNK}}}', 0)), chunks -> array_join(concat(transform({new}_kept, p -> {_between('p.from', 'p.to')}), array({_between(f'{new}_rest', 'length(text)')})), '{said}'))[0]"
    text = F.when(F.col(f"{new}_kept").isNotNull(), F.expr(blocks)).otherwise(F.col("text"))
    joined = joined.withColumn(new, text)
    cols = [
        F.col(new).alias(c) if c == "text"
        else F.when(F.col(f"{new}_kept").isNotNull(), F.length(new).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "n_chars"
        else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return joined.select(*cols)
