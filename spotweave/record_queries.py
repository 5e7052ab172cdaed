"""More of the query catalogue: sequence edits, tags, orders, matrices, and files written and read again."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from spotweave.functions import sequences as sq
from spotweave.operators import intervals
from spotweave.operators import barcodes as bc
from spotweave.operators import matrix as mx
from spotweave.operators import reads as rd
from spotweave.operators import tags as tg
from spotweave.operators import spatial
from spotweave.queries import COUNTS, IV, READS, WL, _alignments, derived_counts, derived_intervals, derived_reads, derived_whitelist, query, sequenced, table
from spotweave.sources import readers, writers
from spotweave.sources.scratch import fresh_folder

# Sequence edits ----------------------------------------------------------------


@query(f"with {READS} select read_id, concat(substr(seq,1,16), substr(seq,29,20)) as hard, substr(seq,4,length(seq)-8) as ends, substr(seq,1,20) as clipped from seqs")
def trim_reads(spark, d):
    return sequenced(spark, d).select("read_id", sq.hard_trim("seq", 16, 29, 20).alias("hard"), sq.trim_ends("seq", 3, 5).alias("ends"), sq.clip("seq", 20).alias("clipped"))


@query(f"with {READS} select substr(bc, cast(i as int), 5) as kmer, count(*) as n from reads, range(1,13) t(i) group by 1")
def kmer_counts(spark, d):
    return derived_reads(spark, d).select(F.explode(sq.kmers("bc", 5)).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n"))


@query(f"with {READS} select read_id, cast(levenshtein(bc, true_bc) as int) as dist from reads")
def barcode_edit_distance(spark, d):
    return derived_reads(spark, d).select("read_id", F.levenshtein("bc", "true_bc").alias("dist"))


@query(f"with {READS} select read_id, concat('CTACACGACGCTCTTCCGATCT', substr(bc,1,8), 'TCTTCAGCGTTCCCGAGA', substr(bc,9)) as built from reads")
def barcode_insert_adapter(spark, d):
    p = sq.split_barcode("bc", 8)
    return derived_reads(spark, d).select("read_id", sq.insert_adapter(p["part1"], p["part2"], "TCTTCAGCGTTCCCGAGA", "CTACACGACGCTCTTCCGATCT").alias("built"))


@query(f"with {READS}, r as (select read_id, bc, concat(substr(bc,1,8), '_', substr(bc,9), '-1') as raw from reads) select read_id, raw, bc as cleaned from r")
def barcode_strip_suffix(spark, d):
    raw = F.concat(F.substring("bc", 1, 8), F.lit("_"), F.substring("bc", 9, 8), F.lit("-1"))
    return derived_reads(spark, d).select("read_id", raw.alias("raw"), sq.strip_suffix(raw).alias("cleaned"))


@query("select p_partkey, p_name as id, p_brand as symbol, cast(2 + length(p_type) - length(replace(p_type, ' ', '')) as int) as fields from part")
def feature_name_fields(spark, d):
    p = sq.pipes_to_columns(F.concat_ws("|", "p_name", "p_brand"))
    return table(spark, d, "part").select("p_partkey", p[0].alias("id"), p[1].alias("symbol"), (F.size(p) + F.length("p_type") - F.length(F.replace("p_type", F.lit(" "), F.lit("")))).alias("fields"))


@query("select doc_id, text as plain from documents")
def log_strip_ansi(spark, d):
    coloured = F.concat(F.lit("\x1b[1;31m"), "text", F.lit("\x1b[0m\x1b[K"))
    return table(spark, d, "documents").select("doc_id", sq.strip_ansi(coloured).alias("plain"))


@query(f"""with {READS}, s as (select read_id, substr(seq, 1, 30 + cast(event_id % 40 as int)) as seq from (select event_id, r.read_id, seq from reads r join seqs s on r.read_id = s.read_id))
select 'above_50' as filter, count(*) filter (length(seq) > 50) as n from s union all select 'below_50', count(*) filter (length(seq) < 50) from s
union all select 'least_50', count(*) filter (length(seq) >= 50) from s union all select 'uneven', count(*) filter (length(seq) <> 50) from s""")
def length_filters(spark, d):
    r = derived_reads(spark, d)
    seq = F.substring(F.concat("bc", "umi", F.lit("T" * 12), "cdna"), F.lit(1), (30 + F.col("event_id") % 40).cast("int"))
    s = r.select("read_id", seq.alias("seq"), F.lit("I" * 50).alias("qual"))
    parts = {"above_50": rd.longer_than(s, 50), "below_50": rd.shorter_than(s, 50), "least_50": rd.at_least(s, 50), "uneven": rd.mismatched_quality(s)}
    named = [p.select(F.lit(k).alias("filter")) for k, p in parts.items()]
    out = named[0]
    for p in named[1:]:
        out = out.union(p)
    return out.groupBy("filter").agg(F.count("*").alias("n"))


@query(f"with {READS} select read_id, cast(least(32, 10 + event_id % 25) as int) as n1, cast(event_id % 20 as int) as n2 from reads where 10 + event_id % 25 >= 28 and event_id % 20 >= 12")
def pair_min_lengths(spark, d):
    r = derived_reads(spark, d)
    mate = lambda n: r.select("read_id", F.substring("cdna", F.lit(1), n.cast("int")).alias("seq")).withColumn("qual", F.col("seq"))
    pairs = rd.pair_mates(mate(10 + F.col("event_id") % 25), mate(F.col("event_id") % 20))
    return rd.long_pairs(pairs, 28).select("read_id", F.length("r1.seq").alias("n1"), F.length("r2.seq").alias("n2"))


@query(f"""with {IV} select name, "start" + stop as readlength, round(case when "start" + stop <> 0 then "start" / ("start" + stop) end, 9) as "normStart" from iv""")
def adapter_positions(spark, d):
    return rd.scan_positions(derived_intervals(spark, d)).select("name", "readlength", F.round("normStart", 9).alias("normStart"))


@query(f"with {WL} select concat(substr(barcode,1,8), substr(barcode,9)) as barcode, cast(spot as bigint) as line from wl")
def whitelist_zip(spark, d):
    w = derived_whitelist(spark, d)
    part = lambda a: w.select(F.col("spot").alias("line"), F.substring("barcode", a, 8).alias("barcode"))
    return bc.zip_whitelists(part(1), part(9))


# Alignments ----------------------------------------------------------------------


@query(f"""with {READS}, a as (select *, (event_id % 3)*8 as flag, list_transform(regexp_extract_all(cdna, '(A+|C+|G+|T+)'), lambda x: length(x)) as lens from reads)
select read_id as "Read_ID", 32 as "Read_Length", cast(list_max(lens) as int) as "Longest_Homopolymer", substr(regexp_extract_all(cdna, '(A+|C+|G+|T+)')[list_position(lens, list_max(lens))], 1, 1) as "Homopolymer_Base", round_even(100.0::double*(32-length(translate(cdna,'GC','')))/32,2) as "GC_Percent", substr(cdna,1,1) as "First_Base", right(cdna,1) as "Last_Base",
(flag & 4) > 0 as is_unmapped, (flag & 2) > 0 as is_proper_pair, (flag & 256) > 0 as is_secondary, umi as "UR" from a""")
def alignment_qc(spark, d):
    return rd.alignment_qc(_alignments(spark, d), ["UR"])


@query(f"""with {READS} select read_id as qname, case when event_id % 12 = 0 then 'NA' else concat('chr', cast(event_id % 12 as varchar)) end as gn, bc as cr, umi as ur, 'UR' as kept from reads""")
def tags_from_names(spark, d):
    a = _alignments(spark, d)
    a = a.withColumn("rname", F.when(F.col("rname") == "chr0", "*").otherwise(F.col("rname")))
    r = derived_reads(spark, d).select(F.col("read_id").alias("id"), F.concat_ws("_", "read_id", "bc", "umi").alias("long"))
    a = tg.chromosome_tag(tg.drop(a, ["CB", "NH", "GN"])).join(r, F.col("qname") == F.col("id"))
    kept = F.array_join(F.array_sort(F.array_except(F.map_keys("tags"), F.array(F.lit("GN")))), ",").alias("kept")
    out = tg.id_to_tags(a.withColumn("qname", F.col("long")).withColumn("before", kept))
    return out.select(F.col("id").alias("qname"), tg.value("GN").alias("gn"), tg.value("CR").alias("cr"), tg.value("UR").alias("ur"), F.col("before").alias("kept"))


@query(f"""with {READS} select 'empty' as state, count(*) filter (event_id % 5 = 0) as n from reads union all select 'present', count(*) filter (event_id % 2 = 0) from reads
union all select 'cleared', count(*) from reads union all select 'unmapped', 0""")
def tag_states(spark, d):
    a = _alignments(spark, d)
    parts = {"empty": tg.tag_empty(a, "CB"), "present": tg.tag_present(a, "GN"), "cleared": tg.unmapped(tg.clear_alignment(a)).where("rname = '*' and pos = 0 and cigar = '*'"), "unmapped": tg.unmapped(a)}
    names = spark.createDataFrame([(k,) for k in parts], "state string")
    out = None
    for k, p in parts.items():
        one = p.select(F.lit(k).alias("state"))
        out = one if out is None else out.union(one)
    return names.join(out.groupBy("state").agg(F.count("*").alias("n")), "state", "left").fillna(0, ["n"])


@query(f"with {READS} select a.read_id as qname, bc as sq from reads a where event_id % 3 <> 0")
def sequence_attach(spark, d):
    reads = derived_reads(spark, d).where("event_id % 3 <> 0").select("read_id", F.col("bc").alias("seq"))
    return tg.attach_sequence(_alignments(spark, d), reads).select("qname", tg.value("SQ").alias("sq"))


@query("""with c as (select distinct event_id % 12 as k from events) select concat('chr', cast(k as varchar)) as rname, row_number() over (order by k) as place from c""")
def chromosome_version_order(spark, d):
    names = _alignments(spark, d).select("rname", tg.version_key().alias("key")).distinct()
    # dense_index numbers the keys by sorted partitions and keeps them as ``name``.
    ranked = mx.dense_index(names.select("key"), "key").withColumnRenamed("name", "key")
    return names.join(ranked, "key").select("rname", (F.col("ix") + 1).cast("long").alias("place"))


@query(f"""with {READS}, m as (select event_id % 12 as c, event_id % 9000 as pos, row_number() over (order by event_id % 12, event_id % 9000) as line from reads)
select line, concat('chr', cast(c as varchar)) as rname, pos from m""")
def merge_alignment_files(spark, d):
    """Two sets merged in order, written, and read with the numbers of their lines: the order itself is compared."""
    path = fresh_folder(spark, "merged")
    a = _alignments(spark, d)
    merged = tg.merge([a.where("event_id % 2 = 0"), a.where("event_id % 2 = 1")])
    merged.select(F.concat_ws(":", "rname", F.col("pos").cast("string")).alias("value")).write.text(path)
    p = F.split("value", ":")
    return readers.numbered_lines(spark, path).select((F.col("line") + 1).alias("line"), p[0].alias("rname"), p[1].cast("long").alias("pos"))


# Matrices and intervals ----------------------------------------------------------


@query(f"with {COUNTS}, s as (select cell, sum(n) as s from c group by 1) select cell from s where s > 0")
def nonzero_cells(spark, d):
    return mx.nonzero_cells(derived_counts(spark, d))


@query(f"with {COUNTS} select gene as cell, cell as gene, sum(n) as n from c where cell % 2 = 0 and gene % 3 = 0 group by 1, 2")
def matrix_subset_transpose(spark, d):
    x = derived_counts(spark, d)
    m = mx.Matrix(x, x.select("cell").distinct(), x.select("gene").distinct())
    m = m.keep_raw().subset(m.obs.where("cell % 2 = 0"), m.var.where("gene % 3 = 0")).transposed()
    return m.x.groupBy("cell", "gene").agg(F.sum("n").alias("n"))


@query(f"with {COUNTS}, s as (select cell, gene, sum(n) as n from c group by 1, 2) select 'raw' as part, gene as cell, cell as gene, n from s union all select 'basis', gene, null, null from s where cell % 2 = 0 group by gene")
def matrix_raw_and_basis(spark, d):
    """What a filtered, turned matrix keeps of the whole one, and its coordinates by the new cells."""
    m = mx.from_long(derived_counts(spark, d)).keep_raw()
    m = m.subset(cells=m.obs.where("cell % 2 = 0"))
    turned = replace(m, obsm={"spatial": m.x.select("gene").distinct()}).transposed()
    basis = turned.obsm["spatial"].select(F.lit("basis").alias("part"), "cell", F.lit(None).cast("long").alias("gene"), F.lit(None).cast("double").alias("n"))
    return turned.raw.select(F.lit("raw").alias("part"), "cell", "gene", "n").unionByName(basis)


@query("""with f as (select p_partkey, p_name, p_brand from part), m as (select p_name, arg_max(concat(p_brand, '/', p_name), p_partkey) as nm from f where p_partkey % 2 = 0 group by 1),
r as (select p_partkey, coalesce(nm, p_name) as renamed from f left join m using (p_name)), k as (select *, row_number() over (partition by renamed order by p_partkey) - 1 as i from r)
select p_partkey, renamed, case when i > 0 then concat(renamed, '-', cast(i as varchar)) else renamed end as unique_name from k""")
def rename_features(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    mapping = p.where("p_partkey % 2 = 0").select(F.col("p_name").alias("old"), F.concat_ws("/", "p_brand", "p_name").alias("new"), "p_partkey")
    last = mapping.select("old", "new", "p_partkey")
    return mx.rename_features(p.select("p_partkey", "p_name"), "p_name", last, "p_partkey").select("p_partkey", "renamed", "unique_name")


@query("""with t as (select event_type, event_id, row_number() over (partition by event_type order by value desc, event_id) as r from events)
select cast(r as int) as rank, max(case when event_type='click' then event_id end) as click, max(case when event_type='error' then event_id end) as error, max(case when event_type='purchase' then event_id end) as purchase,
max(case when event_type='signup' then event_id end) as signup, max(case when event_type='view' then event_id end) as view from t where r <= 10 group by 1""")
def top_n_wide(spark, d):
    e = table(spark, d, "events")
    return mx.wide(mx.top_per_group(e, "event_type", [F.desc("value"), F.col("event_id")], 10), "event_type", "event_id")


@query(f"with {IV}, k as (select chrom from iv group by 1 having count(*) >= 100) select name, count(*) as n from iv where chrom in (select chrom from k) group by 1")
def large_chromosomes(spark, d):
    return intervals.large_chromosomes(derived_intervals(spark, d), 100).groupBy("name").agg(F.count("*").alias("n"))


@query("select vec_id as cell, round(cast(embedding[1] as double) * 2, 6) as x, round(cast(embedding[2] as double) * 0.5, 6) as y from embeddings")
def image_frame(spark, d):
    p = table(spark, d, "embeddings").select(F.col("vec_id").alias("cell"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return spatial.to_frame(p, (1000.0, 2000.0), (2000.0, 1000.0)).select("cell", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


# Files written and read again ------------------------------------------------------


@query(f"with {READS} select read_id, seq, repeat('I', length(seq)) as qual from seqs")
def fastq_files(spark, d):
    path = fresh_folder(spark, "fastq")
    writers.fastq(sequenced(spark, d), path)
    return readers.fastq(spark, path).select("read_id", "seq", "qual")


@query(f"with {READS} select read_id as qname, cast((event_id % 3)*8 as int) as flag, concat('chr', cast(event_id % 12 as varchar)) as rname, event_id % 9000 as pos, cdna as seq, umi as ur, cast(event_id % 7 as varchar) as nh from reads")
def sam_files(spark, d):
    path = fresh_folder(spark, "sam")
    writers.sam(_alignments(spark, d), path, by_chromosome=True)
    return readers.sam(spark, f"{path}/*").select("qname", "flag", "rname", "pos", "seq", tg.value("UR").alias("ur"), tg.value("NH").alias("nh"))


@query(f"with {COUNTS} select cell, gene, sum(n) as n from c group by 1, 2")
def matrix_market_files(spark, d):
    path = fresh_folder(spark, "matrix")
    counts = derived_counts(spark, d).select(F.col("gene").cast("string"), F.col("cell").cast("string"), "n")
    coo, cells, genes = mx.long_to_coo(counts)
    writers.matrix_market(coo, cells, genes, path)
    m = readers.matrix_folder(spark, path)
    return m.x.select(F.col("cell").cast("long"), F.col("gene").cast("long"), "n")


@query(f"with {READS} select read_id, case when event_id % 4 = 0 then '-' else bc end as bc, umi from reads")
def barcode_table_files(spark, d):
    path = fresh_folder(spark, "calls")
    calls = derived_reads(spark, d).select("read_id", F.when(F.col("event_id") % 4 != 0, F.col("bc")).alias("bc"), "umi")
    writers.tsv(calls, path, compression="gzip")
    return readers.tsv(spark, path, ["read_id", "bc", "umi"])


@query(f"with {IV} select chrom, \"start\", stop as \"end\", name, '.' as score, strand from iv")
def interval_files(spark, d):
    """BED to GTF to BED: one-based and closed in between."""
    bed_path, gtf_path = fresh_folder(spark, "bed"), fresh_folder(spark, "gtf")
    writers.bed(derived_intervals(spark, d).withColumn("score", F.lit(".")), bed_path)
    writers.bed_to_gtf(readers.bed(spark, bed_path)).write.text(gtf_path)
    return writers.gtf_to_bed(readers.gtf(spark, gtf_path, feature="gene"))


@query("select p_partkey as id, cast(length(replace(p_name, ' ', '')) as int) as n_bases, concat(p_brand, ' >x A>G') as biotype from part where contains(p_brand, '#1')")
def fasta_files(spark, d):
    """FASTA with three lines a record and more '>' in headers and lines, filtered by a keyword in the header."""
    path = fresh_folder(spark, "fasta")
    half = F.floor(F.length("p_name") / 2).cast("int") + 1
    name = F.concat(F.lit("x"), "p_name")
    lines = F.concat_ws("\n", F.concat(F.lit(">"), F.col("p_partkey").cast("string"), F.lit("|gene|"), "p_brand", F.lit(" >x A>G|")), F.substring(name, F.lit(1), half), F.substring(name, half + 1, F.length(name)))
    table(spark, d, "part").select(lines.alias("value")).write.text(path)
    r = readers.rrna_records(readers.fasta_fields(readers.fasta(spark, path)), ["Brand#1"])
    return r.select(F.col("id").cast("long"), (F.length("seq") - 1).alias("n_bases"), "biotype")


@query("select event_type, count(*) as n, min(event_id) as lo, max(event_id) as hi from events group by 1")
def files_by_group(spark, d):
    path = fresh_folder(spark, "groups")
    writers.by_value(table(spark, d, "events"), "event_type", "event_id", path)
    ids = spark.read.text(path).withColumn("id", F.col("value").cast("long"))
    return ids.groupBy("event_type").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))


@query(f"""with {IV}, e as (select chrom, strand, case when strand = '-' then stop - 1 else "start" end as p from iv)
select chrom, strand, p as "start", cast(case when strand = '-' then -count(*) else count(*) end as double) as value from e group by 1, 2, 3""")
def strand_tracks(spark, d):
    """bedGraph files of 5' ends for each strand, minus negated, read again and cut into single bases."""
    path = fresh_folder(spark, "tracks")
    start, stop = sq.five_prime("start", "end", "strand")
    ends = derived_intervals(spark, d).select("chrom", "strand", start.alias("s"), stop.alias("e")).toDF("chrom", "strand", "start", "end")
    cov = intervals.genome_coverage(ends, ("chrom", "strand"))
    for name, s in (("plus", "+"), ("minus", "-")):
        writers.bedgraph(intervals.signed_track(cov.where(F.col("strand") == s), s), f"{path}/strand={name}")
    rows = spark.read.option("basePath", path).csv(f"{path}/*", sep="\t", schema="chrom string, start long, end long, value double, strand string")
    strand = F.when(F.col("strand") == "minus", "-").otherwise("+")
    return rows.select("chrom", strand.alias("strand"), F.explode(F.sequence("start", F.col("end") - 1)).alias("start"), "value")


@query("select 'segment' as list, c_mktsegment as name, count(*) as n from customer group by 2 union all select 'nation', cast(c_nationkey as varchar), count(*) from customer group by 2")
def gene_list_files(spark, d):
    path = fresh_folder(spark, "lists")
    writers.csv(table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation")), path)
    return readers.gene_lists(spark, path).groupBy("list", "name").agg(F.count("*").alias("n"))
