"""The query catalogue: each operator applied to whole driver tables, with DuckDB SQL for the same rows.

Reads, a whitelist and intervals are derived from ``events`` and ``customer``
by md5, so both engines see the same sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.functions import sequences as sq
from spotweave.operators import barcodes as bc
from spotweave.operators import hmm, intervals, spatial
from spotweave.operators import matrix as mx
from spotweave.operators import reads as rd
from spotweave.operators import tags as tg
from spotweave.operators import umis as um
from spotweave.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ADAPTER1, ADAPTER2 = "CTACACGACGCTCTTCCGATCT", "CCCATGTACTCTGCGTTGATACCACTG"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Derived inputs --------------------------------------------------------------


def dna(c: Column, n: int = 32) -> Column:
    return F.translate(F.substring(F.md5(c.cast("binary")), 1, n), "0123456789abcdef", "ACGTACGTACGTACGT")


def derived_reads(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    key = lambda p, c, n=32: dna(F.concat(F.lit(p), c.cast("string")), n)
    i, true = F.col("event_id"), F.col("true_bc")
    p = (i % 16).cast("int") + 1
    rest = F.substring(true, p + 1, F.length(true))
    sub = F.concat(F.substring(true, F.lit(1), p - 1), F.translate(F.substring(true, p, F.lit(1)), "ACGT", "CGTA"), rest)
    gap = F.concat(F.substring(true, F.lit(1), p - 1), rest, F.lit("A"))
    return e.select(
        "event_id", F.concat(F.lit("r"), i.cast("string")).alias("read_id"), F.col("event_type").alias("gene"),
        key("c", F.col("user_id"), 16).alias("true_bc"), key("u", i % 50, 12).alias("umi"), key("d", i).alias("cdna"),
    ).withColumn("bc", F.when(i % 6 == 0, sub).when(i % 6 == 1, gap).otherwise(true))


def derived_whitelist(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        k.alias("spot"), dna(F.concat(F.lit("c"), k.cast("string")), 16).alias("barcode"), (k % 40).cast("double").alias("x"), F.floor(k / 40).cast("double").alias("y")
    )


def sequenced(spark: SparkSession, d: str) -> DataFrame:
    """(read_id, seq, qual): barcode, UMI, poly-T and cDNA."""
    r = derived_reads(spark, d).withColumn("seq", F.concat("bc", "umi", F.lit("T" * 12), "cdna"))
    return r.select("read_id", "gene", "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))


def long_sequenced(spark: SparkSession, d: str) -> DataFrame:
    r = derived_reads(spark, d)
    s = F.concat(F.lit(ADAPTER1), "bc", "umi", F.lit("T" * 12), "cdna", sq.revcomp(F.lit(ADAPTER2)))
    r = r.withColumn("seq", F.when(F.col("event_id") % 4 == 3, sq.revcomp(s)).otherwise(s))
    return r.select("read_id", "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))


CHROMS = ["click", "error", "purchase", "signup", "view"]


def derived_intervals(spark: SparkSession, d: str) -> DataFrame:
    """One interval an event, spread along its chromosome by its id."""
    i = F.col("event_id")
    start = i * 37
    return table(spark, d, "events").select(
        F.concat(F.lit("i"), i.cast("string")).alias("name"), F.col("event_type").alias("chrom"), start.alias("start"), (start + 50 + i % 100).alias("end"), F.when(i % 2 == 0, "+").otherwise("-").alias("strand")
    )


def derived_features(spark: SparkSession, d: str) -> DataFrame:
    """One feature an order, spread over the same chromosomes."""
    k = F.col("o_orderkey")
    chrom = F.element_at(F.array(*[F.lit(c) for c in CHROMS]), (k % 5 + 1).cast("int"))
    return table(spark, d, "orders").select(F.concat(F.lit("g"), k.cast("string")).alias("gene"), chrom.alias("chrom"), (k * 9).alias("start"), (k * 9 + 40 + k % 60).alias("end"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"))


def derived_counts(spark: SparkSession, d: str) -> DataFrame:
    """(cell, gene, n) from line items."""
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_partkey").alias("gene"), F.col("l_quantity").cast("double").alias("n"))


DNA = lambda x: f"translate(md5({x}),'0123456789abcdef','ACGTACGTACGTACGT')"
WL = f"wl as (select c_custkey as spot, substr({DNA("concat('c',cast(c_custkey as varchar))")},1,16) as barcode, cast(c_custkey % 40 as double) as x, cast(floor(c_custkey/40) as double) as y from customer)"
READS = f"""b as (select event_id, event_type, substr({DNA("concat('c',cast(user_id as varchar))")},1,16) as true_bc,
  substr({DNA("concat('u',cast(event_id % 50 as varchar))")},1,12) as umi, cast(event_id % 16 as int)+1 as p, {DNA("concat('d',cast(event_id as varchar))")} as cdna from events),
reads as (select event_id, concat('r',cast(event_id as varchar)) as read_id, event_type as gene, true_bc, umi,
  case event_id % 6 when 0 then concat(substr(true_bc,1,p-1), translate(substr(true_bc,p,1),'ACGT','CGTA'), substr(true_bc,p+1))
  when 1 then concat(substr(true_bc,1,p-1), substr(true_bc,p+1), 'A') else true_bc end as bc, cdna from b),
seqs as (select read_id, gene, concat(bc, umi, repeat('T',12), cdna) as seq from reads)"""
IV = "iv as (select concat('i',cast(event_id as varchar)) as name, event_type as chrom, event_id*37 as start, event_id*37 + 50 + event_id%100 as stop, case when event_id%2=0 then '+' else '-' end as strand from events)"
FEATURES = f"feats as (select concat('g',cast(o_orderkey as varchar)) as gene, ({CHROMS})[cast(o_orderkey%5 as int)+1] as chrom, o_orderkey*9 as start, o_orderkey*9 + 40 + o_orderkey%60 as stop, case when o_orderkey%2=0 then '+' else '-' end as strand from orders)"
MATCH = """km(bc, len) as (select bc, 16 from (select distinct bc from reads where bc not in (select barcode from wl))),
qk as (select distinct bc, substr(bc, cast(i as int), 5) as g from km, range(1,13) t(i)),
wk as (select distinct barcode, substr(barcode, cast(i as int), 5) as g from wl, range(1,13) t(i)),
cand as (select distinct bc, barcode from qk join wk using (g)),
d as (select bc, c.barcode, levenshtein(bc, c.barcode) as d from cand c join wl on wl.barcode = c.barcode),
r as (select bc, barcode, d, row_number() over (partition by bc order by d, barcode) as k from d where d < 16),
best as (select km.bc, max(case when k=1 then barcode end) as corr, coalesce(min(case when k=1 then d end),16) as dist,
  coalesce(min(case when k=2 then d end),16) - coalesce(min(case when k=1 then d end),16) as margin from km left join r on r.bc = km.bc and k <= 2 group by km.bc
  union all select distinct bc, bc, 0, null from reads where bc in (select barcode from wl))"""
COUNTS = "c as (select l_suppkey as cell, l_partkey as gene, cast(l_quantity as double) as n from lineitem)"


# Reads -----------------------------------------------------------------------


@query(f"""with {READS}, h as (select *, list_transform(regexp_extract_all(seq, '(A+|C+|G+|T+)'), lambda x: length(x)) as lens from seqs)
select read_id as "Read_ID", cast(length(seq) as int) as "Read_Length", round_even(100.0::double*(length(seq)-length(translate(seq,'GC','')))/length(seq),2) as "GC_Percent",
round_even(100.0::double*(length(seq)-length(translate(seq,'GA','')))/length(seq),2) as "Purine_Percent", substr(seq,1,1) as "First_Base", right(seq,1) as "Last_Base",
cast(list_max(lens) as int) as "Longest_Homopolymer", substr(regexp_extract_all(seq,'(A+|C+|G+|T+)')[list_position(lens, list_max(lens))],1,1) as "Homopolymer_Base" from h""")
def read_qc(spark, d):
    return rd.read_qc(sequenced(spark, d))


@query(f"with {READS} select read_id, translate(reverse(seq),'ACGTN','TGCAN') as rc from seqs")
def revcomp_reads(spark, d):
    return sequenced(spark, d).select("read_id", sq.revcomp("seq").alias("rc"))


@query("select round(avg(length(text)),6) as mean_len, cast(trunc(avg(length(text))) as bigint) as mean_len_int, round(stddev_pop(length(text)),6) as sd_len from documents")
def read_length_stats(spark, d):
    return rd.length_stats(table(spark, d, "documents"), "text").withColumns({"mean_len": F.round("mean_len", 6), "sd_len": F.round("sd_len", 6)})


VISIUM = ([rd.Element(0, 16)], [rd.Element(16, 12)])


@query(f"with {READS} select read_id, substr(seq,1,16) as bc, substr(seq,17,12) as umi from seqs")
def barcode_extract_positional(spark, d):
    return rd.call_barcodes(sequenced(spark, d), *VISIUM).select("read_id", F.col("bcs")[0].alias("bc"), F.col("umis")[0].alias("umi"))


@query(f"""with {READS}, s as (select substr(seq, 1, 14 + event_id % 20) as s from (select *, concat(bc, umi, repeat('T',12), cdna) as seq from reads))
select count(*) as total_reads, count(*) filter (length(s) >= 16) as bc_match_count, cast(0 as bigint) as bc_missing_count, count(*) filter (length(s) < 16) as no_bc_count,
count(*) filter (length(s) >= 28) as umi_match_count, cast(0 as bigint) as umi_missing_count, count(*) filter (length(s) between 16 and 27) as no_umi_count from s""")
def barcode_call_stats(spark, d):
    r = derived_reads(spark, d)
    cut = r.select("read_id", F.substring(F.concat("bc", "umi", F.lit("T" * 12), "cdna"), F.lit(1), (14 + F.col("event_id") % 20).cast("int")).alias("seq"))
    return rd.call_stats(rd.call_barcodes(cut, *VISIUM))


@query(f"with {WL} select barcode, substr(barcode,1,8) as part1, substr(barcode,9) as part2, concat(substr(barcode,1,8),'_',substr(barcode,9)) as joined from wl")
def whitelist_split(spark, d):
    return bc.split_whitelist(derived_whitelist(spark, d), 8)


@query(f"""with {WL}, p as (select substr(barcode,1,4) as part1, substr(barcode,5) as part2 from wl)
select 'part1' as part, count(part1) as n, count(distinct part1) as n_unique, round_even(100.0::double*count(distinct part1)/count(part1),2) as pct_unique from p
union all select 'part2', count(part2), count(distinct part2), round_even(100.0::double*count(distinct part2)/count(part2),2) from p""")
def whitelist_uniqueness(spark, d):
    return bc.uniqueness(bc.split_whitelist(derived_whitelist(spark, d), 4), ["part1", "part2"])


@query(f"with {WL}, {READS} select read_id, bc from reads where bc in (select barcode from wl)")
def barcode_exact_match(spark, d):
    return bc.in_whitelist(derived_reads(spark, d).select("read_id", "bc"), derived_whitelist(spark, d)).select("read_id", "bc")


def _corrected(spark, d):
    calls = derived_reads(spark, d).select("read_id", F.array("bc").alias("bcs"))
    return bc.correct(calls, [derived_whitelist(spark, d)])


def _corrected_alike(spark, d):
    """Reads with the same barcode as one row, with their number."""
    calls = derived_reads(spark, d).select("read_id", F.array("bc").alias("bcs"))
    return bc.correct(bc.alike(calls), [derived_whitelist(spark, d)], keep=["reads"])


@query(f"""with {WL}, {READS}, {MATCH} select read_id, reads.bc as orig, case when dist = 0 or (dist <= 2 and margin >= 1) then corr end as corr, cast(dist as int) as dist, cast(margin as int) as margin from reads join best using (bc)""")
def barcode_correct_full(spark, d):
    p = F.col("parts")[0]
    return _corrected(spark, d).select("read_id", p["orig"].alias("orig"), p["kept"].alias("corr"), p["dist"].cast("int").alias("dist"), p["margin"].cast("int").alias("margin"))


@query(f"with {WL}, {READS}, {MATCH} select read_id, corr as cb from reads join best using (bc) where corr is not null")
def barcode_correct_slim(spark, d):
    return bc.slim(_corrected(spark, d))


@query(f"""with {WL}, {READS}, {MATCH}, j as (select *, dist = 0 or (dist <= 2 and margin >= 1) as ok0 from reads join best using (bc)), k as (select *, coalesce(ok0 and corr is not null, false) as ok from j)
select cast(0 as int) as part, count(*) as total, count(*) filter (ok) as corrected, round_even(100.0::double*count(*) filter (ok)/count(*),4) as efficiency,
round_even(coalesce(avg(dist) filter (ok),0),4) as mean_dist_corrected, round_even(coalesce(avg(dist) filter (not ok),0),4) as mean_dist_uncorrected, round_even(coalesce(avg(dist+margin) filter (margin is not null),0),4) as mean_second_dist from k""")
def barcode_correction_summary(spark, d):
    return bc.correction_summary(_corrected_alike(spark, d), "reads")


@query(f"""with {WL}, {READS}, {MATCH}, g as (select dist, count(*) as n from reads join best using (bc) group by 1)
select cast(0 as int) as part, cast(dist as int) as dist, n, round_even(100.0::double*n/sum(n) over (),2) as pct from g""")
def barcode_distance_histogram(spark, d):
    return bc.distance_histogram(_corrected_alike(spark, d), "reads").withColumn("dist", F.col("dist").cast("int"))


@query(f"""with {WL}, {READS}, {MATCH}, u as (select corr as cell, count(distinct (gene, umi)) as n_counts, count(distinct gene) as n_genes from reads join best using (bc) where corr is not null group by 1)
select cell, cast(n_counts as double) as n_counts, n_genes, row_number() over (order by n_counts desc, n_genes desc, cell) as rank from u""")
def corrected_umi_knee(spark, d):
    """The flagship: extraction, whitelist correction, UMI counts, cells ranked for a knee plot."""
    calls = rd.call_barcodes(sequenced(spark, d), *VISIUM, keep=["gene"]).select("gene", "bcs", F.col("umis")[0].alias("umi"))
    fixed = bc.slim(bc.correct(calls, [derived_whitelist(spark, d)], keep=["gene", "umi"]))
    counts = um.count_exact(fixed.withColumnRenamed("cb", "cell"))
    return mx.knee_ranks(mx.cell_qc(counts)).select("cell", "n_counts", "n_genes", "rank")


@query()
def adapter_scan_classify(spark, d):
    return rd.adapter_scan(long_sequenced(spark, d), [ADAPTER1], [ADAPTER2])


@query()
def split_long_reads(spark, d):
    return rd.split_reads(long_sequenced(spark, d), ADAPTER1, "TTTTTTTT").select("read_id", "status", F.col("r1.seq").alias("r1"), F.col("r2.seq").alias("r2"))


@query()
def barcode_extract_adapter(spark, d):
    recipe = [rd.Element(ADAPTER1, 16)], [rd.Element(ADAPTER1, 12, 16)]
    return rd.call_barcodes(long_sequenced(spark, d), *recipe).select("read_id", F.col("bcs")[0].alias("bc"), F.col("umis")[0].alias("umi"))


@query()
def internal_adapter_trim(spark, d):
    r = derived_reads(spark, d).select("read_id", F.concat(F.substring("bc", 1, 8), F.lit("TCTTCAGCGTTCCCGAGA"), F.substring("bc", 9, 6), F.substring("umi", 1, 7)).alias("seq"))
    return rd.internal_trim(r.withColumn("qual", F.repeat(F.lit("I"), F.length("seq"))), ["TCTTCAGCGTTCCCGAGA"])


@query("""with s as (select cast(50 + event_id % 97 as int) as readlen, event_type as lab from events)
select lab, count(*) as n, round_even(avg(readlen),2) as mean, round_even(cast(median(readlen) as double),2) as median, round_even(cast(min(readlen) as double),2) as min, round_even(cast(max(readlen) as double),2) as max from s group by lab""")
def adapter_scan_summary(spark, d):
    return rd.scan_summary(table(spark, d, "events").select((50 + F.col("event_id") % 97).cast("int").alias("readlen"), F.col("event_type").alias("lab")))


@query("""select event_id, value from events, (select avg(value) as m, stddev_samp(value) as s from events) where abs(value - m) <= 3*s""")
def outlier_filter_3sd(spark, d):
    return rd.within_3sd(table(spark, d, "events").select("event_id", "value"), "value")


@query(f"with {READS} select lens as bin, count(*) as n, base from (select list_max(list_transform(regexp_extract_all(seq,'(A+|C+|G+|T+)'), lambda x: length(x))) as lens, right(seq,1) as base from seqs) group by 1,3")
def homopolymer_hist(spark, d):
    h = sequenced(spark, d).select(sq.homopolymer_max("seq").alias("h"), sq.last_base("seq").alias("base"))
    return rd.histogram(h, "h", 1, ["base"]).withColumn("bin", F.col("bin").cast("long")).select("bin", "n", "base")


@query("select event_id, md5(cast(event_id as varchar)) as h from events order by md5(cast(event_id as varchar)), event_id limit 500")
def downsample_hash(spark, d):
    e = table(spark, d, "events").select("event_id")
    return rd.downsample(e, "event_id", 500).select("event_id", F.md5(F.col("event_id").cast("string").cast("binary")).alias("h"))


@query("select doc_id from documents where (contains(text, 'that') or contains(text, 'que')) and not contains(text, 'token')")
def keyword_filter(spark, d):
    return mx.names_like(table(spark, d, "documents"), "text", ["that", "que"], ["token"]).select("doc_id")


@query("""with l as (select doc_id, unnest(range(1, len(t) + 1)) as i, unnest(t) as line from (select doc_id, string_split(text, chr(10)) as t from documents)),
s as (select doc_id, i, case when i % 3 = 1 then concat('>>>>>>> ', substr(line,1,5)) else concat('k', cast(i as varchar), ' = ', cast(length(line) as varchar), ' (', cast(i as varchar), '%)') end as v from l),
c as (select *, last_value(case when v like '>>>>>>> %' then trim(substr(v,9)) end ignore nulls) over (partition by doc_id order by i rows unbounded preceding) as section from s)
select doc_id, section, split_part(v,' = ',1) as key, trim(regexp_replace(regexp_replace(split_part(v,' = ',2), '\\(.*?\\)', '', 'g'), '[%,]', '', 'g')) as value from c where contains(v, ' = ')""")
def section_report_parse(spark, d):
    """One report a document, of headings and key = value lines."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).withColumn("i", F.col("p") + 1)
    v = F.when(F.col("i") % 3 == 1, F.concat(F.lit(">>>>>>> "), F.substring("line", 1, 5))).otherwise(F.concat(F.lit("k"), F.col("i").cast("string"), F.lit(" = "), F.length("line").cast("string"), F.lit(" ("), F.col("i").cast("string"), F.lit("%)")))
    return readers.report_lines(lines.select("doc_id", "i", v.alias("value")), "i", by=["doc_id"])


# Tags and joins ----------------------------------------------------------------


@query("""with t as (select user_id, arg_max(event_type, event_id) as v from events where event_type is not null and event_type not in ('-','NA','click') group by 1)
select c_custkey, v as tag from customer left join t on c_custkey = user_id""")
def tag_attach_last_wins(spark, d):
    t = tg.tag_table(table(spark, d, "events"), "user_id", ["event_type"], "event_id", ("-", "NA", "click"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("qname"), F.expr(f"cast(map() as {tg.TAGS})").alias("tags"))
    return tg.attach(c, t, {"ET": "event_type"}).select(F.col("qname").alias("c_custkey"), tg.value("ET").alias("tag"))


@query("select event_type as value, count(*) as n from events where event_type in ('click','view') group by 1")
def excluded_tag_tally(spark, d):
    return tg.excluded_values(table(spark, d, "events"), ["event_type"], ("click", "view"))


@query("select o_orderkey as read_id from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 45)")
def semi_join_ids(spark, d):
    ids = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("read_id"))
    return tg.only_ids(table(spark, d, "orders").select(F.col("o_orderkey").alias("read_id")), ids)


@query("select o_orderkey as read_id from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45)")
def anti_join_ids(spark, d):
    ids = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("read_id"))
    return tg.without_ids(table(spark, d, "orders").select(F.col("o_orderkey").alias("read_id")), ids)


def _alignments(spark, d):
    """Alignments with tags CB ('-' for every fifth), NH and, for even ones, GN."""
    r = derived_reads(spark, d)
    i = F.col("event_id")
    tag = lambda n, v, k="Z": (n, v, k)
    out = r.select(
        F.col("read_id").alias("qname"), ((i % 3) * 8).cast("int").alias("flag"), F.concat(F.lit("chr"), (i % 12).cast("string")).alias("rname"), (i % 9000).alias("pos"), (i % 61).cast("int").alias("mapq"),
        F.when(i % 3 == 0, "20M5N12M").otherwise("5S27M").alias("cigar"), F.lit("*").alias("rnext"), F.lit(0).cast("long").alias("pnext"), F.lit(0).cast("long").alias("tlen"), F.col("cdna").alias("seq"), F.repeat(F.lit("I"), F.length("cdna")).alias("qual"),
        F.expr(f"cast(map() as {tg.TAGS})").alias("tags"), "event_id", "true_bc", "umi", "gene",
    )
    for n, v, k in (tag("CB", F.when(i % 5 == 0, "-").otherwise(F.col("true_bc"))), tag("UR", F.col("umi")), tag("NH", (i % 7).cast("string"), "i"), tag("GN", F.when(i % 2 == 0, F.col("gene")))):
        out = tg.with_tag(out, n, v, k)
    return out


@query(f"with {READS} select read_id as qname, concat(true_bc, umi) as xb from reads where event_id % 5 <> 0 and event_id % 2 = 0 and event_id % 7 between 1 and 4 and event_id % 61 < 40")
def tag_filters(spark, d):
    a = tg.mapq_below(tg.tag_at_most(tg.tag_at_least(tg.tag_present(tg.tag_filled(_alignments(spark, d), "CB"), "GN"), "NH", 1), "NH", 4), 40)
    return tg.combine(a, ["CB", "UR"], "XB").select("qname", tg.value("XB").alias("xb"))


@query(f"with {READS} select (event_id % 3)*8 >= 16 as reverse, count(*) as n from reads where event_id % 61 >= 1 and event_id % 5 <> 0 group by 1")
def strand_split_counts(spark, d):
    a = tg.dedup_ready(_alignments(spark, d), ["CB"])
    fwd, rev = tg.strand(a, True).select(F.lit(False).alias("reverse")), tg.strand(a, False).select(F.lit(True).alias("reverse"))
    return fwd.union(rev).groupBy("reverse").agg(F.count("*").alias("n"))


@query(f"""with {READS}, a as (select read_id as name, event_id % 3 = 0 as spliced, event_id % 9000 as pos, concat('chr', cast(event_id % 12 as varchar)) as chrom, case when event_id % 3 = 2 then '-' else '+' end as strand from reads)
select chrom, pos - 1 as start, case when spliced then pos + 19 else pos + 26 end as "end", name, strand from a union all select chrom, pos + 24, pos + 36, name, strand from a where spliced""")
def cigar_blocks(spark, d):
    return intervals.cigar_blocks(_alignments(spark, d)).select("chrom", "start", "end", "name", "strand")


ALIGNED = f"""{READS}, al as (select read_id as qname, (event_id % 3)*8 as flag, concat('chr', cast(event_id % 12 as varchar)) as rname, event_id % 9000 as pos, event_id % 61 as mapq,
  case when event_id % 3 = 2 then event_id % 9000 + 27 when event_id % 3 = 1 then event_id % 9000 - 5 else event_id % 9000 end as five, event_id % 3 = 2 as rev, case when event_id % 5 = 0 then '-' else true_bc end as cb, umi from reads)"""


@query(f"with {ALIGNED}, k as (select *, row_number() over (partition by rname, five, rev, cb, umi order by mapq desc, qname) as n from al) select qname, rname, pos, cast(mapq as int) as mapq from k where n = 1")
def dedup_alignments(spark, d):
    return um.dedup_positions(_alignments(spark, d), umi="UR").select("qname", "rname", "pos", "mapq")


# Counts and matrices -------------------------------------------------------------


@query(f"with {READS} select true_bc as cell, gene, count(distinct umi) as n from reads group by 1,2")
def umi_count_exact(spark, d):
    return um.count_exact(derived_reads(spark, d).withColumnRenamed("true_bc", "cell"))


@query(f"""with recursive {READS}, n as (select true_bc as cell, gene, substr(umi, 1, 3) as u, count(*) as c from reads group by 1, 2, 3), o as (select *, row_number() over (partition by cell, gene order by c desc, u) as k from n),
e as (select a.cell, a.gene, a.k as src, b.k as dst from o a join o b on a.cell = b.cell and a.gene = b.gene and hamming(a.u, b.u) = 1 and a.c >= 2 * b.c - 1),
r as (select * from e union select r.cell, r.gene, r.src, e.dst from r join e on r.cell = e.cell and r.gene = e.gene and r.dst = e.src)
select cell, gene, count(*) as n from o where not exists (select 1 from r where r.cell = o.cell and r.gene = o.gene and r.dst = o.k and r.src < o.k) group by 1, 2""")
def umi_count_directional(spark, d):
    """UMIs of three bases, so that many are neighbours: one is a cluster of its own unless one that comes earlier leads to it."""
    return um.count_directional(derived_reads(spark, d).withColumnRenamed("true_bc", "cell").withColumn("umi", F.substring("umi", 1, 3)))


@query(f"""with {COUNTS} select cast(dense_rank() over (order by cell) - 1 as int) as cell_ix, cast(dense_rank() over (order by gene) - 1 as int) as gene_ix, n
from (select cell, gene, sum(n) as n from c where n <> 0 group by 1,2)""")
def long_to_coo(spark, d):
    return mx.long_to_coo(derived_counts(spark, d))[0]


@query(f"with {COUNTS}, s as (select cell, gene, sum(n) as n from c group by 1,2) select cell, sum(n) as n_counts, count(*) filter (n > 0) as n_genes from s group by 1")
def cell_qc(spark, d):
    return mx.cell_qc(mx.from_long(derived_counts(spark, d)).x)


@query(f"with {COUNTS}, s as (select cell, gene, sum(n) as n from c group by 1,2), q as (select cell, sum(n) as n_counts, count(*) filter (n > 0) as n_genes from s group by 1) select *, row_number() over (order by n_counts desc, n_genes desc, cell) as rank from q")
def knee_rank(spark, d):
    return mx.knee_ranks(mx.cell_qc(mx.from_long(derived_counts(spark, d)).x))


@query(f"""with {COUNTS}, s as (select cell, gene, sum(n) as n from c group by 1,2), q as (select s_suppkey as cell, coalesce(sum(n),0) as n_counts, count(n) as n_genes from supplier left join s on s_suppkey = cell group by 1)
select count(*) as n_cells, sum(n_counts) as total_counts, round(avg(n_counts),6) as mean_counts, cast(median(n_counts) as double) as median_counts, round(avg(n_genes),6) as mean_genes, cast(median(n_genes) as double) as median_genes,
(select count(*) from s) as n_entries, (select count(distinct gene) from s) as genes_detected, (select count(*) from part) as n_genes from q""")
def matrix_qc(spark, d):
    cells, genes = table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell")), table(spark, d, "part").select(F.col("p_partkey").alias("gene"))
    return mx.matrix_qc(mx.from_long(derived_counts(spark, d)).x, cells, genes).withColumns({"mean_counts": F.round("mean_counts", 6), "mean_genes": F.round("mean_genes", 6)})


@query(f"""with {COUNTS}, s as (select cell, p_brand as category, sum(n) as s from c join part on gene = p_partkey group by 1,2) select cell, category, round(s / sum(s) over (partition by cell), 9) as share from s""")
def category_share(spark, d):
    var = table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("category"))
    return mx.category_share(derived_counts(spark, d), var, "category").withColumn("share", F.round("share", 9))


@query(f"with {COUNTS} select gene, sum(n) as total from c group by 1 order by 2 desc, 1 limit 50")
def top_genes(spark, d):
    return mx.top_genes(derived_counts(spark, d), 50)


@query(f"""with {COUNTS}, s as (select cell, gene, sum(n) as n from c group by 1,2), r as (select *, cast(row_number() over (partition by cell order by n desc, gene) as int) as rank from s) select cell, gene, n, rank from r where rank <= 5""")
def top_n_per_group(spark, d):
    return mx.top_per_group(mx.from_long(derived_counts(spark, d)).x, "cell", [F.desc("n"), F.asc("gene")], 5).select("cell", "gene", "n", "rank")


@query("select gene, p_name, p_brand from (select distinct l_partkey + 3 as gene from lineitem) left join part on gene = p_partkey")
def annotate_left_join(spark, d):
    genes = table(spark, d, "lineitem").select((F.col("l_partkey") + 3).alias("gene")).distinct()
    return mx.annotate_genes(genes, table(spark, d, "part").select(F.col("p_partkey").alias("gene"), "p_name", "p_brand"))


@query(f"""with {COUNTS}, a as (select cell, gene, sum(n) as n from c where cell % 3 <> 0 group by 1, 2), b as (select cell, gene, sum(n) as n from c where cell % 2 = 0 group by 1, 2)
select 'x' as part, cell, gene, n from a union all select 'layer', cell, gene, n from b union all (select 'obs', cell, null, null from a union select 'obs', cell, null, null from b) union all (select 'var', null, gene, null from a union select 'var', null, gene, null from b)""")
def layer_union(spark, d):
    """Counts, layer and both dimension tables of a union."""
    x = derived_counts(spark, d)
    other = mx.from_long(x.where("cell % 2 = 0")).x
    both = mx.from_long(x.where("cell % 3 <> 0")).add_layer("other", other, "union")
    none = lambda kind: F.lit(None).cast(kind)
    parts = [both.x.select(F.lit("x").alias("part"), "cell", "gene", "n"), both.layers["other"].select(F.lit("layer").alias("part"), "cell", "gene", "n")]
    parts += [both.obs.select(F.lit("obs").alias("part"), "cell", none("long").alias("gene"), none("double").alias("n")), both.var.select(F.lit("var").alias("part"), none("long").alias("cell"), "gene", none("double").alias("n"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"""with {COUNTS}, a as (select * from c where cell % 3 <> 0), b as (select * from c where cell % 2 = 0)
select cell, gene, sum(n) as n from a where cell in (select cell from b) and gene in (select gene from b) group by 1,2""")
def layer_intersect(spark, d):
    x = derived_counts(spark, d)
    return mx.from_long(x.where("cell % 3 <> 0")).add_layer("other", x.where("cell % 2 = 0")).x


@query("select c_custkey as user_id, coalesce(n, 0) as tally from customer left join (select user_id, count(*) as n from events group by 1) on c_custkey = user_id")
def barcode_tally(spark, d):
    return bc.barcode_tally(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")), table(spark, d, "events"), "user_id")


@query("select p_partkey, p_brand, case when k > 0 then concat(p_brand, '-', cast(k as varchar)) else p_brand end as unique_name from (select p_partkey, p_brand, row_number() over (partition by p_brand order by p_partkey) - 1 as k from part)")
def make_unique(spark, d):
    return mx.make_unique(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey")


# Intervals -----------------------------------------------------------------------


@query(f"with {IV}, {FEATURES} select a.name as left_name, b.gene as right_name from iv a join feats b on a.chrom = b.chrom and a.start < b.stop and b.start < a.stop")
def interval_overlap(spark, d):
    return intervals.overlaps(derived_intervals(spark, d), derived_features(spark, d), width=500).select(F.col("l.name").alias("left_name"), F.col("r.gene").alias("right_name"))


@query(f"with {IV}, {FEATURES} select t.gene, count(b.name) as n from feats t left join iv b on t.chrom = b.chrom and t.strand = b.strand and t.start < b.stop and b.start < t.stop group by 1")
def interval_coverage(spark, d):
    return intervals.coverage(derived_features(spark, d), derived_intervals(spark, d)).select("gene", "n")


@query(f"with {IV}, {FEATURES} select a.name from iv a where not exists (select 1 from feats b where a.chrom = b.chrom and a.start < b.stop and b.start < a.stop)")
def interval_unannotated(spark, d):
    return intervals.not_overlapping(derived_intervals(spark, d), derived_features(spark, d), width=500).select("name")


def merged_sql(gap: int) -> str:
    return f"""t as (select *, max(stop) over (partition by chrom, strand order by start, stop rows between unbounded preceding and 1 preceding) as reach from iv),
g as (select *, sum(case when reach is null or start > reach + {gap} then 1 else 0 end) over (partition by chrom, strand order by start, stop rows unbounded preceding) as grp from t),
merged as (select chrom, strand, min(start) as start, max(stop) as stop, count(*) as n from g group by chrom, strand, grp)"""


@query(f"with {IV}, {merged_sql(150)} select chrom, strand, start, stop as \"end\", n from merged")
def interval_merge(spark, d):
    return intervals.merge_intervals(derived_intervals(spark, d), 150)


def region_sql(gap: int, least: int) -> str:
    return f"""{IV}, {FEATURES}, {merged_sql(gap)},
regions as (select m.chrom, m.strand, m.start, m.stop, concat_ws('_', m.chrom, cast(m.start as varchar), cast(m.stop as varchar), m.strand) as name from merged m join iv b on m.chrom = b.chrom and m.strand = b.strand and m.start < b.stop and b.start < m.stop
  where not exists (select 1 from feats f where f.chrom = m.chrom and f.start < m.stop and m.start < f.stop) group by 1, 2, 3, 4, 5 having count(*) >= {least})"""


def _active(spark, d):
    iv = derived_intervals(spark, d)
    return intervals.active_regions(iv, iv, derived_features(spark, d), gap=150, least=2, width=500)


@query(f"with {region_sql(150, 2)} select chrom, strand, start, stop as \"end\", name from regions")
def active_regions(spark, d):
    return _active(spark, d).select("chrom", "strand", "start", "end", "name")


@query(f"""with {READS}, {region_sql(150, 2)}, hit as (select b.name, r.name as gene, count(*) over (partition by b.name) as n from iv b join regions r on b.chrom = r.chrom and b.strand = r.strand and b.start < r.stop and r.start < b.stop)
select true_bc as cell, hit.gene, count(distinct umi) as n from hit join reads on concat('i', cast(event_id as varchar)) = name where hit.n = 1 group by 1, 2""")
def active_region_counts(spark, d):
    cells = derived_reads(spark, d).select(F.concat(F.lit("i"), F.col("event_id").cast("string")).alias("name"), F.col("true_bc").alias("cell"), "umi")
    return intervals.region_counts(derived_intervals(spark, d), _active(spark, d), cells, width=500)


@query(f"""with {IV}, e as (select chrom, start as loc, 1 as d from iv union all select chrom, stop, -1 from iv), s as (select chrom, loc, sum(d) as d from e group by 1,2 having sum(d) <> 0),
w as (select chrom, loc as start, lead(loc) over (partition by chrom order by loc) as stop, cast(sum(d) over (partition by chrom order by loc) as bigint) as depth from s) select chrom, start, stop as "end", depth from w where depth > 0 and stop is not null""")
def genome_coverage(spark, d):
    return intervals.genome_coverage(derived_intervals(spark, d))


@query(f"with {IV} select name, case when strand = '-' then stop - 1 else start end as start, case when strand = '-' then stop else start + 1 end as \"end\" from iv")
def five_prime_ends(spark, d):
    s, e = sq.five_prime("start", "end", "strand")
    return derived_intervals(spark, d).select("name", s.alias("start"), e.alias("end"))


@query(f"""with {IV}, {FEATURES}, h as (select a.name, b.gene from iv a join feats b on a.chrom = b.chrom and a.strand = b.strand and a.start < b.stop and b.start < a.stop group by 1, 2),
p as (select name, count(*) as n, min(gene) as gene from h group by 1)
select iv.name as read_id, case when n is null then 'Unassigned_NoFeatures' when n = 1 then 'Assigned' else 'Unassigned_Ambiguity' end as status, coalesce(n, 0) as n_targets, case when n = 1 then gene end as targets from iv left join p on iv.name = p.name""")
def feature_assignment(spark, d):
    return intervals.assign_features(derived_intervals(spark, d), derived_features(spark, d), width=500)


@query(f"""with {IV}, {FEATURES}, h as (select a.name, b.gene, sum(least(a.stop, b.stop) - greatest(a.start, b.start)) as bases from iv a join feats b on a.chrom = b.chrom and a.start < b.stop and b.start < a.stop group by 1, 2),
p as (select name, gene, row_number() over (partition by name order by bases desc, gene) as k from h)
select iv.name as read_id, case when gene is null then 'Unassigned_NoFeatures' else 'Assigned' end as status, gene as targets from iv left join p on iv.name = p.name and k = 1""")
def feature_assignment_largest(spark, d):
    return intervals.assign_features(derived_intervals(spark, d), derived_features(spark, d), stranded=False, largest=True, width=500).drop("n_targets")


def derived_transcription(spark: SparkSession, d: str) -> DataFrame:
    """A read an event: 400 ids in succession are a locus of 20,000 bases, where nine of ten start in a transcribed stretch and the others anywhere."""
    i = F.col("event_id")
    locus, at = F.floor(i / 400), i % 400
    within = F.when(i % 10 == 0, at * 50).otherwise(6000 + locus % 7 * 1000 + at * (3 + locus % 5))
    chrom = F.element_at(F.array(*[F.lit(c) for c in CHROMS]), (locus % 5 + 1).cast("int"))
    return table(spark, d, "events").select(chrom.alias("chrom"), F.when(locus % 2 == 0, "+").otherwise("-").alias("strand"), (F.floor(locus / 10) * 20_000 + within).alias("start"))


@query()
def transcribed_regions(spark, d):
    return hmm.transcribed_regions(derived_transcription(spark, d))


# Space -----------------------------------------------------------------------------


def _points(spark, d):
    e = F.col("embedding")
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("cell"), e[0].cast("double").alias("x"), e[1].cast("double").alias("y"))


PTS = "pts as (select vec_id as cell, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y from embeddings)"


@query(f"with {PTS} select a.cell, count(*) as n_neighbors from pts a join pts b on sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) < 0.05 group by 1")
def spatial_neighbors(spark, d):
    return spatial.neighbour_counts(_points(spark, d), 0.05)


def singlet_sql(rounds: int, distance: float, more_than: int) -> str:
    steps = [f"p{k + 1} as materialized (select a.cell, a.x, a.y from p{k} a join p{k} b on a.x between b.x - {distance} and b.x + {distance} and sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) < {distance} group by all having count(*) > {more_than})" for k in range(rounds)]
    return f"with {PTS}, p0 as (select * from pts), {', '.join(steps)} select * from p{rounds}"


@query(singlet_sql(10, 0.05, 3))
def spatial_singlet_filter(spark, d):
    return spatial.drop_singlets(_points(spark, d), 0.05, 3)


@query()
def tissue_segments(spark, d):
    p = _points(spark, d).withColumn("section", F.col("cell") % 8)
    return spatial.segment_tissues(p, threshold=0.1, section="section")


@query(f"with {PTS} select cell, x, y, abs(x) + abs(y) < 0.15 as roi from pts")
def roi_polygon(spark, d):
    return spatial.in_polygon(_points(spark, d), [(0.15, 0.0), (0.0, 0.15), (-0.15, 0.0), (0.0, -0.15)])


@query(f"""with {PTS}, c as (select avg(x) as cx, avg(y) as cy from pts), r as (select cell, cx+(x-cx)*cos(radians(30))+(y-cy)*sin(radians(30)) as x, cy-(x-cx)*sin(radians(30))+(y-cy)*cos(radians(30)) as y from pts, c)
select cell, round(2*x - min(2*x) over (), 6) as x, round(3*y - min(3*y) over (), 6) as y from r""")
def rotate_rescale(spark, d):
    out = spatial.rescale(spatial.rotate(_points(spark, d), 30), (2.0, 3.0), to_zero=True)
    return out.select("cell", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("select cast(i - 1 as int) as dim, round(var_pop(cast(embedding[i] as double)),6) as variance from embeddings, range(1,65) t(i) group by 1")
def pca_variance(spark, d):
    return spatial.dimension_variance(table(spark, d, "embeddings")).withColumn("variance", F.round("variance", 6))


@query("""with v as (select i, var_pop(cast(embedding[i] as double)) as v from embeddings, range(1,65) t(i) group by 1), r as (select sum(v) over (order by i) as run, sum(v) over () as total from v) select count(*) filter (run < 0.95*total) + 1 as n_dims from r""")
def dims_for_variance(spark, d):
    return spatial.dims_for_share(spatial.dimension_variance(table(spark, d, "embeddings")))


