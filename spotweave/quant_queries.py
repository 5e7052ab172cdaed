"""Queries of counting when reads fit several genes, of assembled transcripts and of BUS files, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.operators import quantify as qt
from spotweave.operators import transcripts as tr
from spotweave.operators import spatial, trimming
from spotweave.queries import ADAPTER1, CHROMS, READS, WL, _points, derived_reads, derived_whitelist, query, table
from spotweave.sources import bus, readers, writers
from spotweave.sources.scratch import fresh_folder

# Molecules of several genes ---------------------------------------------------

HITS = "hits as (select distinct l_orderkey % 50 as cell, l_orderkey as umi, l_partkey % 60 as gene from lineitem)"
#: Rounds that the query makes, so that SQL can make the same.
ROUNDS = 5


def _em_sql(rounds: int) -> str:
    steps = ",\n".join(
        f"a{i + 1} as (select cell, g, sum(x) as n from (select cell, g, x from one union all select m.cell, m.g, m.n * a.n / sum(a.n) over (partition by m.cell, m.id) from m join a{i} a on a.cell = m.cell and a.g = m.g) group by 1, 2)"
        for i in range(rounds)
    )
    return f"""with {HITS}, s as (select cell, umi, list(gene order by gene) as genes from hits group by 1, 2),
c as (select cell, genes, count(*) as n, row_number() over () as id from s group by 1, 2),
one as (select cell, genes[1] as g, cast(n as double) as x from c where len(genes) = 1),
m as (select cell, id, n, unnest(genes) as g, len(genes) as k from c where len(genes) > 1),
a0 as (select cell, g, sum(x) as n from (select cell, g, x from one union all select cell, g, n / k::double from m) group by 1, 2),
{steps}
select cell, g as gene, round(n, 6) as n from a{rounds}"""


def derived_hits(spark: SparkSession, d: str) -> DataFrame:
    """Orders as molecules, the parts of their lines as the genes they fit."""
    return table(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("cell"), F.col("l_orderkey").alias("umi"), (F.col("l_partkey") % 60).alias("gene"))


@query(_em_sql(ROUNDS))
def em_gene_counts(spark, d):
    return qt.em_counts(derived_hits(spark, d), tolerance=0, rounds=ROUNDS).select("cell", "gene", F.round("n", 6).alias("n"))


# Correction by evidence, and near UMIs -----------------------------------------

QUALITY = "chr(cast(33 + 2 + (event_id * 7 + x * 11) % 38 as int))"


@query(f"""with {WL}, {READS}, w as (select distinct barcode from wl),
r as (select read_id, bc, case when event_id % 5 = 4 then null else list_aggregate(list_transform(range(1, 17), lambda x: {QUALITY}), 'string_agg', '') end as q from reads),
seen as (select bc, count(*) as n from r group by 1), u as (select distinct bc from r where bc not in (select barcode from w)),
near as (select u.bc, w.barcode, coalesce(s.n, 0) + 1.0::double as n, list_position(list_transform(range(1, 17), lambda i: substr(u.bc, cast(i as int), 1) <> substr(w.barcode, cast(i as int), 1)), true) as p
  from u join w on length(u.bc) = length(w.barcode) and hamming(u.bc, w.barcode) = 1 left join seen s on s.bc = w.barcode),
o as (select r.read_id, near.barcode, n * case when q is null then 0.1::double else pow(10.0::double, -(ascii(substr(q, p, 1)) - 33) / 10.0::double) end as w from r join near on r.bc = near.bc),
z as (select read_id, barcode, w / sum(w) over (partition by read_id) as posterior, row_number() over (partition by read_id order by w desc, barcode) as k from o)
select read_id, barcode, round(posterior, 9) as posterior from z where k = 1 and posterior >= 0.975 union all select read_id, bc, 1.0 from r where bc in (select barcode from w)""")
def barcode_correct_by_evidence(spark, d):
    i = F.col("event_id")
    q = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(16)), lambda x: F.char(33 + 2 + (i * 7 + x * 11) % 38)), "")
    reads = derived_reads(spark, d).withColumn("bc_qual", F.when(i % 5 != 4, q))
    return qt.correct_by_evidence(reads, derived_whitelist(spark, d)).select("read_id", "barcode", F.round("posterior", 9).alias("posterior"))


NEAR = f"""{READS}, r as (select true_bc as cell, concat(substr(umi, 1, 3), substr('ACGT', cast(event_id % 4 as int) + 1, 1), substr('ACGT', cast(floor(event_id / 4) % 4 as int) + 1, 1)) as umi, gene from reads),
per as (select cell, umi, gene, count(*) as n from r group by 1, 2, 3), most as (select *, max(n) over (partition by cell, umi) as m from per),
top as (select cell, umi, min(gene) as gene, min(n) as n from most where n = m group by 1, 2 having count(*) = 1)"""


def _near_reads(spark: SparkSession, d: str) -> DataFrame:
    """Reads with UMIs short enough to have neighbours."""
    i = F.col("event_id")
    base = lambda k: F.substring(F.lit("ACGT"), (k % 4 + 1).cast("int"), F.lit(1))
    return derived_reads(spark, d).select(F.col("true_bc").alias("cell"), F.concat(F.substring("umi", 1, 3), base(i), base(F.floor(i / 4))).alias("umi"), "gene")


@query(f"with {NEAR} select cell, umi, gene, n from top")
def umi_one_gene(spark, d):
    return qt.one_gene_a_umi(_near_reads(spark, d))


@query(f"""with {NEAR}, p as (select a.cell, a.gene, a.umi, b.umi as v, row_number() over (partition by a.cell, a.gene, a.umi order by b.n desc, b.umi desc) as k
  from top a join top b on a.cell = b.cell and a.gene = b.gene and hamming(a.umi, b.umi) = 1 and (b.n > a.n or (b.n = a.n and b.umi > a.umi))),
i as (select distinct t.cell, t.gene, coalesce(p.v, t.umi) as into_ from top t left join p on p.cell = t.cell and p.gene = t.gene and p.umi = t.umi and p.k = 1)
select cell, gene, count(*) as n from i group by 1, 2""")
def umi_count_collapsed(spark, d):
    return qt.count_collapsed(_near_reads(spark, d))


# Transcripts and layers ----------------------------------------------------------

#: Four transcripts a gene, a line of an order an exon; every third line codes.
EXONS = f"""o as (select l_orderkey as t, cast(floor(l_orderkey / 4) as bigint) as g, l_orderkey % 4 as j, l_linenumber as m, l_suppkey, l_partkey from lineitem),
x as (select *, ({CHROMS})[cast(g % 5 as int) + 1] as chrom, case when g % 2 = 0 then '+' else '-' end as strand, g * 1000 + m * 120 + j * 10 as s, g * 1000 + m * 120 + j * 20 + 60 as e from o),
tx as (select concat('t', cast(t as varchar)) as name, concat('g', cast(g as varchar)) as gene, chrom, strand, min(s) as s, max(e) as e, coalesce(min(case when m % 3 = 0 then s + 6 end), max(e)) as ts, coalesce(max(case when m % 3 = 0 then e - 6 end), max(e)) as te,
  list(distinct {{'s': s, 'e': e}} order by {{'s': s, 'e': e}}) as ex from x group by 1, 2, 3, 4)"""


def _exons(spark: SparkSession, d: str) -> DataFrame:
    t, m = F.col("l_orderkey"), F.col("l_linenumber").cast("long")
    g, j = F.floor(t / 4), t % 4
    x = table(spark, d, "lineitem").select(t.alias("t"), g.alias("g"), j.alias("j"), m.alias("m"), "l_suppkey", "l_partkey", F.element_at(F.array(*[F.lit(c) for c in CHROMS]), (g % 5 + 1).cast("int")).alias("chrom"), F.when(g % 2 == 0, "+").otherwise("-").alias("strand"))
    return x.withColumns({"s": F.expr("g * 1000 + m * 120 + j * 10"), "e": F.expr("g * 1000 + m * 120 + j * 20 + 60")})


def derived_annotation(spark: SparkSession, d: str) -> DataFrame:
    """Annotation rows, written as GTF and read back."""
    x = _exons(spark, d)
    row = lambda feature, inner: F.concat_ws("\t", "chrom", F.lit("derived"), F.lit(feature), (F.col("s") + 1 + inner).cast("string"), (F.col("e") - inner).cast("string"), F.lit("."), "strand", F.lit("."), F.concat(F.lit('gene_id "g'), F.col("g").cast("string"), F.lit('"; transcript_id "t'), F.col("t").cast("string"), F.lit('";')))
    lines = x.select(row("exon", 0).alias("value")).unionByName(x.where("m % 3 = 0").select(row("CDS", 6).alias("value")))
    path = fresh_folder(spark, "annotation")
    lines.write.text(path, compression="gzip")
    return readers.gtf(spark, path)


@query(f"""with {EXONS} select chrom, cast(s as bigint) as start, cast(e as bigint) as "end", name, 0 as score, strand, cast(ts as bigint) as thick_start, cast(te as bigint) as thick_end, '0' as rgb, cast(len(ex) as int) as n_blocks,
concat(list_aggregate(list_transform(ex, lambda b: cast(cast(b.e - b.s as bigint) as varchar)), 'string_agg', ','), ',') as sizes, concat(list_aggregate(list_transform(ex, lambda b: cast(cast(b.s - tx.s as bigint) as varchar)), 'string_agg', ','), ',') as starts from tx""")
def transcript_bed12(spark, d):
    return tr.bed12(tr.assemble(derived_annotation(spark, d)))


@query(f"""with {EXONS}, n as (select distinct chrom, strand, concat('t', cast(t as varchar)) as name, s, e from x), l as (select *, lead(s) over (partition by name order by s) as nxt from n)
select chrom, cast(e as bigint) as start, cast(nxt as bigint) as "end", name, cast(0 as bigint) as score, strand from l where nxt is not null""")
def transcript_junctions(spark, d):
    return tr.junctions(tr.assemble(derived_annotation(spark, d)))


def _spliced_reads(spark: SparkSession, d: str) -> DataFrame:
    """A read an exon row, with its cell and UMI: within it, over the junction to the next, or out into the intron."""
    x = _exons(spark, d).withColumn("kind", (F.col("t") + F.col("m")) % 3).withColumn("name", F.concat_ws(":", F.col("t").cast("string"), F.col("m").cast("string")))
    block = lambda a, b: F.struct(F.expr(a).alias("start"), F.expr(b).alias("end"))
    inner = F.array(block("g * 1000 + m * 120 + 32", "g * 1000 + m * 120 + 57"))
    over = F.array(block("e - 20", "e"), block("g * 1000 + (m + 1) * 120 + j * 10", "g * 1000 + (m + 1) * 120 + j * 10 + 20"))
    out = F.array(block("g * 1000 + m * 120 + 50", "g * 1000 + m * 120 + 110"))
    r = x.withColumn("blocks", F.when(F.col("kind") == 0, inner).when(F.col("kind") == 1, over).otherwise(out))
    return r.select("name", "chrom", "strand", F.col("blocks")[0]["start"].alias("start"), F.element_at("blocks", -1)["end"].alias("end"), "blocks", (F.col("l_suppkey") % 20).alias("cell"), (F.col("l_partkey") % 97).alias("umi"))


@query(f"""with {EXONS}, r as (select concat(cast(t as varchar), ':', cast(m as varchar)) as name, l_suppkey % 20 as cell, l_partkey % 97 as umi, chrom, strand,
  case (t + m) % 3 when 0 then [{{'s': g * 1000 + m * 120 + 32, 'e': g * 1000 + m * 120 + 57}}] when 1 then [{{'s': e - 20, 'e': e}}, {{'s': g * 1000 + (m + 1) * 120 + j * 10, 'e': g * 1000 + (m + 1) * 120 + j * 10 + 20}}]
  else [{{'s': g * 1000 + m * 120 + 50, 'e': g * 1000 + m * 120 + 110}}] end as b from x),
p as (select r.name, tx.gene, len(list_filter(b, lambda q: len(list_filter(ex, lambda k: k.s <= q.s and q.e <= k.e)) > 0)) = len(b)
  and (len(b) = 1 or len(list_filter(range(1, len(ex)), lambda i: ex[i].e = b[1].e and ex[i + 1].s = b[2].s)) > 0) as whole
  from r join tx on r.chrom = tx.chrom and r.strand = tx.strand and b[1].s >= tx.s and b[-1].e <= tx.e),
v as (select name, min(gene) as gene, bool_and(whole) as a, bool_or(whole) as o from p group by 1 having min(gene) = max(gene)),
u as (select r.cell, v.gene, r.umi, max(case when a then 1 else 0 end) as s, max(case when not o then 1 else 0 end) as i from v join r on r.name = v.name group by 1, 2, 3)
select cell, gene, cast(sum(case when s > i then 1 else 0 end) as bigint) as spliced, cast(sum(case when i > s then 1 else 0 end) as bigint) as unspliced, cast(sum(case when s = i then 1 else 0 end) as bigint) as ambiguous from u group by 1, 2""")
def velocity_layers(spark, d):
    verdicts = qt.splice_verdicts(_spliced_reads(spark, d), tr.assemble(derived_annotation(spark, d)), width=1000, keep=["cell", "umi"])
    return qt.velocity_counts(verdicts)


# Adapters with gaps ------------------------------------------------------------------

TSO = "AAGCAGTGGTATCAACGCAGAGT"
TRIMMED = [trimming.Adapter("read_end", ADAPTER1, 3, 0.15, 5), trimming.Adapter("switch", TSO, 5, 0.15, 5)]


def adapter_reads(spark: SparkSession, d: str) -> DataFrame:
    """Reads whose 3' adapter is whole, lacks a base, has one more or is cut off by the read's end, a third of them behind a 5' adapter without its first bases."""
    i, a = F.col("event_id"), F.lit(ADAPTER1)
    at = (i % 20 + 2).cast("int")
    begin, rest = F.substring(a, F.lit(1), at), F.substring(a, at + 2, F.length(a))
    tail = F.concat(F.substring(a, at + 1, F.lit(1)), rest, F.substring("cdna", 1, 8))
    three = F.when(i % 4 == 0, F.concat(begin, tail)).when(i % 4 == 1, F.concat(begin, rest, F.substring("cdna", 1, 8))).when(i % 4 == 2, F.concat(begin, F.lit("A"), tail)).otherwise(begin)
    five = F.when(i % 3 == 0, F.substring(F.lit(TSO), (i % 5 + 1).cast("int"), F.lit(len(TSO)))).otherwise("")
    r = derived_reads(spark, d).withColumn("seq", F.concat(five, "cdna", three))
    return r.select("read_id", "seq", F.concat(F.repeat(F.lit("I"), F.length("seq") - 2), F.when(i % 7 == 0, "#!").otherwise("I5")).alias("qual"))


@query()
def trim_with_gaps(spark, d):
    return trimming.trim(adapter_reads(spark, d), TRIMMED, quality=20, rounds=2, trim_n=True).withColumn("cut", F.array_join("cut", ","))


# Tissues ------------------------------------------------------------------------------


@query()
def tissue_components(spark, d):
    return spatial.tissue_components(_points(spark, d).withColumn("section", F.col("cell") % 8), 0.05, section="section")


# BUS files --------------------------------------------------------------------------

RECORDS = f"{WL}, {READS}, w as (select distinct barcode from wl), raw as (select bc, umi, cast(event_id % 25 as int) as ec from reads where not contains(bc, 'N'))"
FIXED = """u as (select distinct bc from raw where bc not in (select barcode from w)),
near as (select u.bc, min(w.barcode) as cell from u join w on length(u.bc) = length(w.barcode) and hamming(u.bc, w.barcode) = 1 group by 1 having count(*) = 1),
fixed as (select raw.bc as cell, umi, ec from raw where bc in (select barcode from w) union all select near.cell, umi, ec from raw join near on raw.bc = near.bc)"""


def _bus_records(spark: SparkSession, d: str) -> DataFrame:
    """Reads as records, written to BUS files and read back in small runs."""
    path = fresh_folder(spark, "bus")
    reads = derived_reads(spark, d).select(F.col("bc").alias("barcode"), "umi", (F.col("event_id") % 25).alias("ec"), F.lit(1).alias("count"), F.lit(0).alias("flags"))
    bus.write_bus(reads, path, 16, 12)
    return bus.read_bus(spark, path, 4096)


@query(f"with {RECORDS}, {FIXED} select cell as barcode, umi, ec, count(*) as count, cast(0 as bigint) as flags from fixed group by 1, 2, 3")
def bus_corrected_sorted(spark, d):
    return bus.sorted_records(bus.corrected(_bus_records(spark, d), derived_whitelist(spark, d)))


@query(f"""with {RECORDS}, {FIXED}, g as (select distinct n_nationkey as ec, cast(floor(t / 3) as bigint) as gene from nation, unnest([n_nationkey, n_nationkey * 7 % 25, (n_nationkey + 1) % 25]) as q(t)),
own as (select distinct cell, umi, ec from fixed), k as (select cell, umi, count(*) as k from own group by 1, 2),
h as (select own.cell, own.umi, g.gene, count(*) as n from own join g on own.ec = g.ec group by 1, 2, 3), s as (select h.cell, h.umi, min(gene) as gene from h join k on h.cell = k.cell and h.umi = k.umi and h.n = k.k group by 1, 2 having count(*) = 1)
select cell, concat('g', cast(gene as varchar)) as gene, count(*) as n from s group by 1, 2""")
def bus_gene_counts(spark, d):
    n, k = table(spark, d, "nation"), F.col("n_nationkey")
    classes, names = fresh_folder(spark, "classes"), fresh_folder(spark, "transcripts")
    n.select(F.concat_ws("\t", k.cast("string"), F.array_join(F.array(k, k * 7 % 25, (k + 1) % 25), ",")).alias("value")).write.text(classes)
    writers.ordered_chunks(n.select("n_nationkey"), "n_nationkey", 3).select(F.concat(F.lit("t"), k.cast("string")).alias("value")).write.text(names)
    genes = n.select(F.concat(F.lit("t"), k.cast("string")).alias("transcript"), F.concat(F.lit("g"), F.floor(k / 3).cast("string")).alias("gene"))
    records = bus.corrected(_bus_records(spark, d), derived_whitelist(spark, d))
    return bus.gene_counts(bus.molecule_genes(records, bus.class_genes(spark, classes, names, genes)))
