"""The rest of the query catalogue: calls and their counters, orders, sheets, whole runs, and more formats written and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from spotweave.functions import sequences as sq
from spotweave.operators import barcodes as bc
from spotweave.operators import matrix as mx
from spotweave.operators import reads as rd
from spotweave.operators import spatial
from spotweave.operators import tags as tg
from spotweave.operators import umis as um
from spotweave.plans import config, pipeline
from spotweave.queries import ALIGNED, COUNTS, MATCH, READS, WL, _alignments, derived_counts, derived_reads, derived_whitelist, query, sequenced, table
from spotweave.sources import readers, writers
from spotweave.sources.scratch import fresh_folder

# Calls, trimming and correction ---------------------------------------------------


def _partial_calls(spark, d):
    """Two barcodes and a UMI a read; every third read lacks the second barcode, every fifth the UMI."""
    i = F.col("event_id")
    r = derived_reads(spark, d)
    return r.select("read_id", F.array(F.substring("bc", 1, 8), F.when(i % 3 != 0, F.substring("bc", 9, 8))).alias("bcs"), F.array(F.when(i % 5 != 0, F.col("umi"))).alias("umis"))


@query(f"with {READS} select read_id, event_id % 5 <> 0 as whole from reads where event_id % 3 <> 0")
def calls_complete(spark, d):
    calls = _partial_calls(spark, d)
    whole = rd.drop_missing_calls(calls).select("read_id", F.lit(True).alias("whole"))
    return rd.complete_calls(calls).select("read_id").join(whole, "read_id", "left").fillna(False)


@query(f"""with {WL}, {READS}, {MATCH} select read_id, corr as cb, case when dist = 0 or (dist <= 2 and margin >= 1) then corr end as kept from reads join best using (bc)""")
def barcode_correct_joined(spark, d):
    """Two parts a read, corrected as one barcode."""
    calls = derived_reads(spark, d).select("read_id", F.array(F.substring("bc", 1, 8), F.substring("bc", 9, 8)).alias("bcs"))
    p = F.col("parts")[0]
    return bc.correct(calls, [derived_whitelist(spark, d)], concat=True).select("read_id", p["corr"].alias("cb"), p["kept"].alias("kept"))


@query(f"""with {WL}, {READS}, {MATCH} select concat_ws(chr(9), read_id, bc, case when dist = 0 or (dist <= 2 and margin >= 1) then corr else '-' end, cast(dist as varchar), case when dist = 0 then 'N' else cast(margin as varchar) end) as line from reads join best using (bc)""")
def correction_files(spark, d):
    path = fresh_folder(spark, "correction")
    calls = derived_reads(spark, d).select("read_id", F.array("bc").alias("bcs"))
    writers.correction_full(bc.correct(calls, [derived_whitelist(spark, d)]), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("select count(*) as reads, count(*) filter (event_id % 4 = 0) as insertions, count(*) filter (event_id % 4 = 1) as deletions, count(*) filter (event_id % 4 = 2) as missing from events")
def trim_counters(spark, d):
    status = F.element_at(F.array(*[F.lit(s) for s in ("insertion", "deletion", "missing", "exact")]), (F.col("event_id") % 4 + 1).cast("int"))
    return rd.trim_stats(table(spark, d, "events").select(status.alias("status")))


@query("select event_type as status, count(*) as n from events group by 1")
def split_counters(spark, d):
    return rd.split_summary(table(spark, d, "events").select(F.col("event_type").alias("status")))


@query()
def trim_adapters(spark, d):
    """3' qualities that fall, an adapter after the barcode of every other read, and N at both ends."""
    r = derived_reads(spark, d)
    i = F.col("event_id")
    seq = F.concat(F.repeat(F.lit("N"), (i % 3).cast("int")), "bc", F.when(i % 2 == 0, F.lit("AGATCGGAAGAGC")).otherwise(F.substring("cdna", 1, 13)), F.substring("umi", F.lit(1), (i % 12 + 1).cast("int")), F.repeat(F.lit("N"), (i % 2).cast("int")))
    r = r.select("read_id", seq.alias("seq"), (i % 9).cast("int").alias("poor"))
    qual = F.concat(F.repeat(F.lit("I"), F.length("seq") - F.col("poor")), F.repeat(F.lit("#"), F.col("poor")))
    return rd.trim_adapters(r.select("read_id", "seq", qual.alias("qual")), ["AGATCGGAAGAGC"]).select("read_id", "seq", "qual")


@query(f"""with {READS} select read_id, case when event_id % 4 = 3 then translate(reverse(bc), 'ACGT', 'TGCA') else bc end as seq, case when event_id % 4 = 3 then reverse(umi) else umi end as qual from reads where event_id % 7 <> 0""")
def stranded_reads(spark, d):
    """Reads turned by the strand of their scan, the qualities (here the UMIs' letters) with them."""
    r = derived_reads(spark, d)
    scan = r.select("read_id", F.when(F.col("event_id") % 4 == 3, "-").otherwise("+").alias("strand"), F.when(F.col("event_id") % 7 == 0, "other").otherwise("full_len").alias("lab"))
    return rd.stranded_reads(r.select("read_id", F.col("bc").alias("seq"), F.col("umi").alias("qual")), rd.full_length(scan))


@query(f"""with {READS} select read_id, translate(reverse(bc),'ACGT','TGCA') as rc, round_even(100.0::double*(16-length(translate(bc,'GC','')))/16,2) as gc, cast(list_max(list_transform(regexp_extract_all(bc,'(A+|C+|G+|T+)'), lambda x: length(x))) as int) as run, bc[3:6] as part, substr(bc, 12, 5) as last_kmer from reads""")
def sql_functions(spark, d):
    """The sequence functions by their names in SQL text."""
    sq.register_sql(spark)
    derived_reads(spark, d).createOrReplaceTempView("spotweave_reads")
    return spark.sql("select read_id, revcomp(bc) as rc, gc_pct(bc) as gc, homopolymer_max(bc) as run, py_slice(bc, 2, 6) as part, element_at(kmers(bc, 5), -1) as last_kmer from spotweave_reads")


# Orders ----------------------------------------------------------------------------


@query(f"with {ALIGNED}, k as (select *, row_number() over (partition by rname, umi order by mapq desc, qname) as n from al) select qname, rname, umi as xb from k where n = 1")
def dedup_by_tag(spark, d):
    return um.dedup_by_tag(tg.combine(_alignments(spark, d), ["UR"], "XB")).select("qname", "rname", tg.value("XB").alias("xb"))


@query(f"with {READS} select umi as ur, count(*) as n, cast(1 as bigint) as runs from reads group by 1")
def tag_sorted(spark, d):
    """Alignments sorted by a tag: each value is one run of rows of one task."""
    rows = tg.tag_sort(_alignments(spark, d), "UR").select(tg.value("UR").alias("ur"), F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("row"))
    per = rows.groupBy("ur", "task").agg(F.count("*").alias("n"), (F.max("row") - F.min("row") + 1).alias("span"))
    return per.groupBy("ur").agg(F.sum("n").alias("n"), F.count_if(F.col("span") == F.col("n")).alias("runs"))


@query("""with v as (select i, var_pop(cast(embedding[i] as double)) as v from embeddings, range(1,65) t(i) group by 1), o as (select list(i order by v desc, i) as o from v)
select vec_id, cast(embedding[o[1]] as double) as first, cast(embedding[o[2]] as double) as second, cast(embedding[o[64]] as double) as last from embeddings, o""")
def dimensions_reordered(spark, d):
    e = F.col("embedding")
    return spatial.reorder_dimensions(table(spark, d, "embeddings")).select("vec_id", e[0].cast("double").alias("first"), e[1].cast("double").alias("second"), e[63].cast("double").alias("last"))


@query("select event_id from events order by event_id limit 250")
def first_rows(spark, d):
    return rd.first_rows(table(spark, d, "events").select("event_id"), "event_id", 250)


@query(f"""with {COUNTS}, s as (select cell, gene, sum(n) as n from c group by 1,2), r as (select *, cast(row_number() over (partition by cell order by n desc, gene) as int) as rank from s) select cell, rank, gene, n from r where rank <= 3""")
def top_n_long(spark, d):
    top = mx.top_per_group(mx.from_long(derived_counts(spark, d)).x, "cell", [F.desc("n"), F.asc("gene")], 3)
    return mx.long_top(top, "cell", "gene")


# Sheets ------------------------------------------------------------------------------


def _sheet(spark, d):
    """A sample a customer, with one or two recipes by its segment and nation."""
    c = table(spark, d, "customer")
    recipes = F.when(F.col("c_nationkey") % 2 == 0, F.concat_ws(" ", F.lower("c_mktsegment"), F.lit("visium"))).otherwise(F.lower("c_mktsegment"))
    return c.select(F.concat(F.lit("s"), (F.col("c_custkey") / 2).cast("long").cast("string")).alias("sampleID"), recipes.alias("recipe"))


SHEET = "sh as (select concat('s', cast(c_custkey // 2 as varchar)) as sampleid, case when c_nationkey % 2 = 0 then concat(lower(c_mktsegment), ' visium') else lower(c_mktsegment) end as recipe from customer), pr as (select sampleid, unnest(string_split(recipe, ' ')) as recipe from sh)"


@query(f"with {SHEET} select sampleid as \"sampleID\", pr.recipe, k as kind, case when recipe = 'visium' then 16 end as bc_length from pr, (select unnest(['bam', 'matrix']) as k)")
def sheet_targets(spark, d):
    """Every output of every sample and recipe, with the recipe's parameters."""
    recipes = spark.createDataFrame([("visium", 16), ("seeker", 14)], "recipe string, bc_length int")
    return config.lookup(config.targets(config.sample_recipes(_sheet(spark, d)), ["bam", "matrix"]), recipes).select("sampleID", "recipe", "kind", "bc_length")


@query(f"with {SHEET} select sampleid as \"sampleID\", count(*) as n from sh group by 1 having count(*) > 1")
def sheet_duplicates(spark, d):
    return config.duplicates(_sheet(spark, d), "sampleID")


# Whole runs ---------------------------------------------------------------------------


@query(f"""with {WL}, {READS}, {MATCH}, f as (select corr as cell, gene, umi from reads join best using (bc) where corr is not null),
c as (select cell, gene, count(distinct umi) as n from f group by 1, 2), q as (select cell, sum(n) as n_counts, count(*) as n_genes from c group by 1)
select cell, x, y, cast(n_counts as double) as n_counts, n_genes from q join wl on barcode = cell where x < 30""")
def annotated_run(spark, d):
    """Reads to an annotated matrix by a recipe; the spatial map lacks some spots."""
    reads = sequenced(spark, d)
    done = pipeline.barcodes_of(reads, config.KNOWN["visium"], [derived_whitelist(spark, d)])
    counts = pipeline.count_reads(done, reads.select("read_id", "gene"))
    m = pipeline.annotated_matrix(counts, derived_whitelist(spark, d).where("x < 30"), spark.createDataFrame([("view", "a look")], "gene string, note string"))
    return m.obs.select("cell", "x", "y", "n_counts", "n_genes")


@query(f"with {READS} select read_id as qname, true_bc as cb, umi as ur, gene as gn from reads where event_id % 4 <> 0 and event_id % 3 <> 0")
def tagged_run(spark, d):
    """Alignments with the barcodes and genes of their reads; every fourth read lacks a barcode, every third a gene."""
    r = derived_reads(spark, d)
    barcoded = r.where("event_id % 4 <> 0").select("read_id", F.col("true_bc").alias("cb"), "umi")
    assigned = r.select("read_id", F.when(F.col("event_id") % 3 != 0, F.col("gene")).alias("targets"))
    a = tg.drop(_alignments(spark, d), ["CB", "UR", "GN"])
    return pipeline.tagged_alignments(a, barcoded, assigned).select("qname", tg.value("CB").alias("cb"), tg.value("UR").alias("ur"), tg.value("GN").alias("gn"))


# Files ----------------------------------------------------------------------------------


@query(f"with {WL} select barcode, x, y from wl")
def spatial_map_files(spark, d):
    path = fresh_folder(spark, "map")
    writers.tsv(derived_whitelist(spark, d).select("barcode", "x", "y"), path)
    return readers.bc_map(spark, path)


def _small_counts(spark, d):
    """Counts of the parts of eight suppliers, with zeros, as strings."""
    x = derived_counts(spark, d).groupBy((F.col("cell") % 8).alias("cell"), "gene").agg(F.sum(F.when(F.col("gene") % 4 != 0, F.col("n")).otherwise(0.0)).alias("n"))
    return x.select(F.col("gene").cast("string"), F.concat(F.lit("c"), F.col("cell").cast("string")).alias("cell"), "n")


SMALL_COUNTS = f"with {COUNTS} select cast(gene as varchar) as gene, concat('c', cast(cell % 8 as varchar)) as cell, sum(n) as n from c where gene % 4 <> 0 group by 1, 2"


@query(SMALL_COUNTS)
def counts_long_files(spark, d):
    path = fresh_folder(spark, "counts")
    writers.tsv(_small_counts(spark, d), path, header=True)
    return readers.counts_long(spark, path)


@query(SMALL_COUNTS)
def counts_wide_files(spark, d):
    path = fresh_folder(spark, "wide")
    wide = _small_counts(spark, d).groupBy("gene").pivot("cell", [f"c{i}" for i in range(8)]).agg(F.first("n")).fillna(0.0)
    writers.tsv(wide, path, header=True)
    return readers.counts_wide(spark, path)


@query("select n_nationkey * 100 as total_reads, cast(n_nationkey + 2 * length(n_name) as bigint) as with_adapters, cast(n_regionkey * 7 as bigint) as reads_written from nation")
def cutadapt_files(spark, d):
    """One JSON report a nation."""
    path = fresh_folder(spark, "cutadapt")
    n = table(spark, d, "nation")
    counts = F.to_json(F.struct((F.col("n_nationkey") * 100).alias("input"), F.col("n_nationkey").alias("read1_with_adapter"), (2 * F.length("n_name")).alias("read2_with_adapter"), (F.col("n_regionkey") * 7).alias("output")))
    report = F.concat(F.lit('{\n "tag": "report",\n "read_counts": '), counts, F.lit("\n}"))
    writers.by_value(n.select("n_nationkey", report.alias("value")), "n_nationkey", "value", path)
    r = readers.cutadapt_json(spark, f"{path}/*")
    return r.select("total_reads", (F.col("reads_with_adapters") + F.col("reads2_with_adapters")).alias("with_adapters"), "reads_written")


@query(f"with {COUNTS} select cell, gene, sum(n) as n, sum(n) * 2 as layer from c group by 1, 2")
def matrix_bundle_files(spark, d):
    path = fresh_folder(spark, "bundle")
    m = mx.from_long(derived_counts(spark, d)).keep_raw()
    m = m.add_layer("twice", m.x.withColumn("n", F.col("n") * 2))
    writers.matrix_bundle(m, path)
    back = readers.matrix_bundle(spark, path)
    x = back.x.join(back.raw.withColumnRenamed("n", "raw"), ["cell", "gene"]).where("n = raw")
    return x.join(back.layers["twice"].withColumnRenamed("n", "layer"), ["cell", "gene"]).join(back.obs, "cell").join(back.var, "gene").select("cell", "gene", "n", "layer")


@query("select event_id, row_number() over (order by event_id) - 1 as line from events")
def chunk_files(spark, d):
    """Seven ordered chunks: their files one after another are in order."""
    path = fresh_folder(spark, "chunks")
    e = table(spark, d, "events").select("event_id")
    writers.ordered_chunks(e, "event_id", 7).select(F.col("event_id").cast("string").alias("value")).write.text(path)
    return readers.numbered_lines(spark, path).select(F.col("value").cast("long").alias("event_id"), "line")


@query(f"with {WL}, {COUNTS} select 'spot' as what, barcode as name, x as v from wl union all select 'gene', cast(gene as varchar), null from c group by gene union all select 'count', concat(cast(cell as varchar), ':', cast(gene as varchar)), sum(n) from c group by cell, gene")
def coordinates_files(spark, d):
    path = fresh_folder(spark, "coordinates")
    m = mx.from_long(derived_counts(spark, d))
    m.obsm["spatial"] = derived_whitelist(spark, d).select(F.col("barcode").alias("cell"), "x", "y")
    writers.coordinates_export(m, path)
    read = lambda name: readers.sheet(spark, f"{path}/{name}")
    number = lambda c: F.col(c).cast("double").alias("v")
    out = read("coordinates").select(F.lit("spot").alias("what"), F.col("cell").alias("name"), number("x"))
    out = out.unionByName(read("genes").select(F.lit("gene").alias("what"), F.col("gene").alias("name"), F.lit(None).cast("double").alias("v")))
    return out.unionByName(read("counts").select(F.lit("count").alias("what"), F.concat_ws(":", "cell", "gene").alias("name"), number("n")))


ROWS = f"""with {READS} select read_id as qname, cast((event_id % 3)*8 as int) as flag, concat('chr', cast(event_id % 12 as varchar)) as rname, event_id % 9000 as pos, cast(event_id % 61 as int) as mapq,
case when event_id % 3 = 0 then '20M5N12M' else '5S27M' end as cigar, cdna as seq, repeat('I', 32) as qual, umi as ur, cast(event_id % 7 as varchar) as nh, 'i' as nh_type from reads"""


def _shown(a):
    return a.select("qname", "flag", "rname", "pos", "mapq", "cigar", "seq", "qual", tg.value("UR").alias("ur"), tg.value("NH").alias("nh"), F.col("tags")["NH"]["type"].alias("nh_type"))


@query(ROWS)
def bam_files(spark, d):
    """BAM files by Spark's writer, read again."""
    path = fresh_folder(spark, "bam")
    writers.bam(_alignments(spark, d), path, rows=3000)
    return _shown(readers.bam(spark, path))


@query(f"""with {READS} select concat('chr', cast(event_id % 12 as varchar)) as name, max(event_id % 9000 - 1 + case when event_id % 3 = 0 then 37 else 27 end) as length, count(*) as n from reads group by 1""")
def sam_header_files(spark, d):
    """SAM with a header: the references that it names, and the rows below it."""
    path = fresh_folder(spark, "sam")
    a = _alignments(spark, d)
    writers.sam(tg.coordinate_sort(a), path, header=True, order="coordinate", read_groups=["s1"])
    rows = readers.sam(spark, path).groupBy(F.col("rname").alias("name")).agg(F.count("*").alias("n"))
    return readers.sam_references(spark, path).join(rows, "name")


@query(f"with {READS} select read_id, bc as seq, repeat('I', 16) as qual from reads")
def mixed_run_files(spark, d):
    """One sample in FASTQ, SAM and BAM files; every other alignment is reversed, and secondary ones aren't reads."""
    folder = fresh_folder(spark, "mixed")
    r = derived_reads(spark, d)
    i = F.col("event_id")
    qual = F.repeat(F.lit("I"), F.length("bc"))
    writers.fastq(r.where(i % 3 == 0).select("read_id", F.col("bc").alias("seq"), qual.alias("qual")), f"{folder}/a.fastq.gz")
    a = _alignments(spark, d).where(i % 3 != 0).join(r.select(F.col("read_id").alias("qname"), "bc"), "qname")
    flag = F.when(i % 2 == 0, 16).otherwise(0)
    a = a.withColumns({"seq": F.when(i % 2 == 0, sq.revcomp("bc")).otherwise(F.col("bc")), "qual": qual, "flag": flag, "cigar": F.lit("16M")})
    a = a.unionByName(a.where(i % 5 == 0).withColumn("flag", F.col("flag") + 256))
    writers.sam(a.where(i % 3 == 1), f"{folder}/b.sam", header=True)
    writers.bam(a.where(i % 3 == 2), f"{folder}/c.bam")
    return readers.reads_of(spark, [f"{folder}/{x}" for x in ("a.fastq.gz", "b.sam", "c.bam")])


@query("""with g as (select p_partkey as id, p_brand as chrom, 1 + p_size * 10 as s, 100 + p_size * 10 as e from part), r as (select id, chrom, 'gene' as feature, 1 as rank, s, e from g union all select id, chrom, 'exon', 4, s, e from g)
select row_number() over (order by chrom, s, e desc, rank) - 1 as line, chrom, feature, s as start from r""")
def gtf_sorted_files(spark, d):
    """Genes and exons, written in order: lines are numbered as they were sorted."""
    path = fresh_folder(spark, "gtf")
    p = table(spark, d, "part")
    both = F.explode(F.array(F.lit("exon"), F.lit("gene")))
    rows = p.select(F.col("p_brand").alias("seqname"), both.alias("feature"), (1 + F.col("p_size") * 10).alias("start"), (100 + F.col("p_size") * 10).alias("end"))
    done = readers.sorted_annotation(rows).select(F.concat_ws("\t", "seqname", "feature", F.col("start").cast("string")).alias("value"))
    done.write.text(path)
    f = F.split("value", "\t")
    return readers.numbered_lines(spark, path).select("line", f[0].alias("chrom"), f[1].alias("feature"), f[2].cast("int").alias("start"))


@query("select 'records' as what, count(*) as n from part union all select p_brand, count(*) from part group by p_brand")
def build_counts(spark, d):
    p = table(spark, d, "part")
    return readers.record_counts(p.select("p_name"), p.select(F.col("p_brand").alias("feature")))
