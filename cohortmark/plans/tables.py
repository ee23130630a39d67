"""The library's tables, derived from the driver's: sequences from documents, edges from orders, intervals from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmark.operators.storage import scratch, stored  # noqa: F401  (queries write below it)
from cohortmark.operators.tiles import tiled

#: Fixed value: bases that letters a to z stand for.
BASES = "ACGTACGTACGTACGTACGTACGNRY"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SEQ_SQL = f"translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}')"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_sequence(text) -> F.Column:
    return F.translate(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]", ""), LETTERS, BASES)


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as genomes, their documents as records."""
    d = read(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    if d.rdd.getNumPartitions() < cores:  # a table of few row groups is dealt out once: what follows multiplies its rows
        d = d.select("doc_id", "source", "lang", "text").repartition(cores)
    return d.select(F.col("source").alias("name"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("seq_id"), F.col("lang").alias("description"), F.col("doc_id").alias("ord"), as_sequence(F.col("text")).alias("seq"))


SEQUENCES = f"seqs AS (SELECT source AS name, 'd' || doc_id AS seq_id, lang AS description, doc_id AS ord, {SEQ_SQL} AS seq FROM documents)"


def primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair for each document with 100 bases: 20 from its start and 20 up to its hundredth base."""
    s = sequences(spark, sf_dir).where(F.length("seq") >= 100)
    return s.select(
        F.concat(F.lit("p"), F.col("ord").cast("string")).alias("name"), F.lit(100).cast("long").alias("size"), F.substring("seq", 1, 20).alias("forward_seq"), F.lit(1).cast("long").alias("forward_start"), F.lit(20).cast("long").alias("forward_length"), F.lit(59.5).alias("forward_tm"), F.lit(50.0).alias("forward_gc"),
        F.substring("seq", 81, 20).alias("reverse_seq"), F.lit(81).cast("long").alias("reverse_start"), F.lit(20).cast("long").alias("reverse_length"), F.lit(58.25).alias("reverse_tm"), F.lit(45.0).alias("reverse_gc"),
        F.lit("").alias("internal_seq"), F.lit(0).cast("long").alias("internal_start"), F.lit(0).cast("long").alias("internal_length"), F.lit(0.0).alias("internal_tm"), F.lit(0.0).alias("internal_gc"),
        F.col("seq_id").alias("source"), F.col("name").alias("sourcename"),
    )


#: A region of 50 bases with 5 more on either side begins at every 500th base, 10 bases on.
REGIONS = """regs AS (SELECT seq_id, name, ord, w, seq, w * 500 + 5 AS a, least(length(seq), w * 500 + 65) AS b FROM
  (SELECT *, unnest(range(0, (length(seq) - 60) // 500 + 1)) AS w FROM seqs WHERE length(seq) >= 60))"""


def regions(sequences: DataFrame) -> DataFrame:
    w = F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 60) / 500).cast("int"))).alias("w")
    rows = sequences.where(F.length("seq") >= 60).select("seq_id", "ord", w)
    return rows.select("seq_id", (F.col("w") * 500 + 10).alias("start"), (F.col("w") * 500 + 60).alias("end"), (F.col("ord") * 1_000_000 + F.col("w")).alias("ord"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences as stored tiles."""
    return stored(tiled(sequences(spark, sf_dir)), "tiles")


PRIMERS = f"{SEQUENCES}, primers AS (SELECT 'p' || ord AS name, substr(seq, 1, 20) AS forward_seq, substr(seq, 81, 20) AS reverse_seq, name AS sourcename, seq_id AS source FROM seqs WHERE length(seq) >= 100)"


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as genomes, labelled by nation, region and, for every other one, parity."""
    n, r, s = (read(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    odd = F.when(F.col("s_suppkey") % 2 == 1, F.array(F.lit("odd"))).otherwise(F.array().cast("array<string>"))
    groups = F.array_sort(F.concat(F.array("n_name", "r_name"), odd))
    path = F.concat(F.lit("in/"), "s_name", F.lit(".fasta"))
    return rows.select(F.col("s_name").alias("name"), groups.alias("groups"), path.alias("seqfile"), F.lit(None).cast("string").alias("filtered_seqfile"), F.when(F.col("s_suppkey") % 3 == 0, path).alias("features"), F.lit(None).cast("string").alias("primers"), F.lit(None).cast("string").alias("primersearch"), F.lit(None).cast("string").alias("target_amplicons"), F.col("s_name").alias("filestem"))


MANIFEST = """man AS (SELECT s_name AS name, list_sort(CASE WHEN s_suppkey % 2 = 1 THEN [n_name, r_name, 'odd'] ELSE [n_name, r_name] END) AS groups,
  'in/' || s_name || '.fasta' AS seqfile, CASE WHEN s_suppkey % 3 = 0 THEN 'in/' || s_name || '.fasta' END AS features
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as chromosomes, events as intervals from their second on, as long as their value says."""
    e = read(spark, sf_dir, "events")
    start = F.unix_timestamp(F.col("ts"))
    return e.select(F.col("user_id").alias("chrom"), start.alias("start"), (start + F.floor(F.col("value") * 600)).alias("end"), "event_type", "event_id").where("value is not null and end > start")


INTERVALS = """iv AS (SELECT user_id AS chrom, floor(epoch(ts))::BIGINT AS "start", floor(epoch(ts))::BIGINT + floor(value * 600)::BIGINT AS "end", event_type, event_id
  FROM events WHERE value IS NOT NULL AND floor(value * 600) > 0)"""


def edge_rows(spark: SparkSession, sf_dir: str):
    """(primers, amplimers): customers as primers, order priorities as genomes, order prices as lengths."""
    o = read(spark, sf_dir, "orders")
    hits = o.select(F.col("o_custkey").alias("primer_name"), F.col("o_orderpriority").alias("target"), F.col("o_totalprice").alias("length"), F.col("o_orderkey").alias("ord"))
    own = o.groupBy("o_custkey").agg(F.min("o_orderpriority").alias("sourcename")).select(F.col("o_custkey").alias("name"), "sourcename")
    return own, hits


LOW, HIGH = 101450, 201635
EDGES = f"""own AS (SELECT o_custkey AS name, min(o_orderpriority) AS sourcename FROM orders GROUP BY 1),
edges AS (SELECT name AS primer, sourcename AS target FROM own
          UNION SELECT o_custkey, o_orderpriority FROM orders WHERE o_totalprice > {LOW} AND o_totalprice < {HIGH}),
hits AS (SELECT primer, list_sort(list(DISTINCT target)) AS targets FROM edges GROUP BY 1)"""
#: Fixed labels over the priorities; one has no primer.
LABELS = {"urgent": ["1-URGENT"], "high": ["1-URGENT", "2-HIGH"], "low": ["4-NOT SPECIFIED", "5-LOW"], "none": ["9-NONE"]}
LABELS_SQL = "labels_t AS (" + " UNION ALL ".join(f"SELECT '{g}' AS \"group\", {m} AS members" for g, m in LABELS.items()) + ")"


def labels(spark: SparkSession) -> DataFrame:
    rows = [(m, [g for g, ms in LABELS.items() if m in ms]) for m in sorted({x for ms in LABELS.values() for x in ms})]
    return spark.createDataFrame(rows, "name string, groups array<string>")


def amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 100 bases along each document, end to end, as amplicons; eight neighbours belong to one primer."""
    s = sequences(spark, sf_dir).withColumn("v", F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / 10_000).cast("int"))))
    s = s.select("seq_id", "v", F.substring("seq", F.col("v") * 10_000 + 1, F.lit(10_000)).alias("seq"))  # in steps, as a place in a long text is walked to
    s = s.withColumn("x", F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / 1_000).cast("int"))))
    s = s.select("seq_id", (F.col("v") * 10 + F.col("x")).alias("v"), F.substring("seq", F.col("x") * 1_000 + 1, F.lit(1_000)).alias("seq"))
    s = s.withColumn("u", F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / 100).cast("int")))).where((F.col("u") + 1) * 100 <= F.length("seq"))
    s = s.withColumn("w", F.col("v") * 10 + F.col("u"))
    primer = F.concat_ws("_", "seq_id", F.floor(F.col("w") / 8).cast("string"))
    return s.select(primer.alias("primer"), F.concat_ws("_", "seq_id", F.col("w").cast("string")).alias("amplicon_name"), F.substring("seq", F.col("u") * 100 + 1, F.lit(100)).alias("seq"))


AMPLICONS = f"""{SEQUENCES}, amps AS (SELECT seq_id || '_' || (w // 8) AS primer, seq_id || '_' || w AS amplicon_name, substr(seq, (w * 100 + 1)::INT, 100) AS seq
  FROM (SELECT *, unnest(range(0, length(seq) // 100)) AS w FROM seqs))"""


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 bases of each document that has them, as amplicons of its source and length class: as many files as there are sources."""
    s = sequences(spark, sf_dir).where(F.length("seq") >= 100)
    return s.select(F.concat_ws("_", "name", (F.col("ord") % 25).cast("string")).alias("primer"), F.col("seq_id").alias("amplicon_name"), F.substring("seq", 1, 100).alias("seq"))


HEADS = f"{SEQUENCES}, amps AS (SELECT name || '_' || (ord % 25) AS primer, seq_id AS amplicon_name, substr(seq, 1, 100) AS seq FROM seqs WHERE length(seq) >= 100)"
