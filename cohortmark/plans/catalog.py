"""Registered queries over the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmark.functions import sequence as S
from cohortmark.operators import chain as G
from cohortmark.operators import classify as C
from cohortmark.operators import degenerate as B
from cohortmark.operators import design as D
from cohortmark.operators import diversity as V
from cohortmark.operators import extend as X
from cohortmark.operators import intervals as I
from cohortmark.operators import manifest as M
from cohortmark.operators import search as H
from cohortmark.operators import sequences as Q
from cohortmark.operators import star as K
from cohortmark.operators import tiles as L
from cohortmark.sources import listing as N
from cohortmark.sources import readers as R
from cohortmark.sources import writers as W

from . import tables as T

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def registered(sql: str | None = None):
    def add(f):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


# Classification


@registered(f"""
WITH {T.EDGES}, {T.LABELS_SQL}, g AS (SELECT "group", list_sort(list(DISTINCT m)) AS members FROM (SELECT "group", unnest(members) AS m FROM labels_t) GROUP BY 1)
SELECT "group", primer FROM hits JOIN g ON hits.targets = g.members""")
def classify_exact_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which markers hit exactly the members of each group?"""
    own, hits = T.edge_rows(spark, sf_dir)
    return C.classify_primers(T.labels(spark), own, hits, T.LOW, T.HIGH)


@registered(f"""
WITH {T.EDGES}, {T.LABELS_SQL}, g AS (SELECT "group", list_sort(list(DISTINCT m)) AS members FROM (SELECT "group", unnest(members) AS m FROM labels_t) GROUP BY 1)
SELECT "group", count(primer) AS n_primers FROM g LEFT JOIN hits ON hits.targets = g.members GROUP BY 1""")
def group_summary_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify_exact_set(spark, sf_dir)
    return C.group_summary_outer(C.process_groups(T.labels(spark)), found)


@registered(f"""
WITH {T.EDGES}, {T.LABELS_SQL}, g AS (SELECT "group", list_sort(list(DISTINCT m)) AS members FROM (SELECT "group", unnest(members) AS m FROM labels_t) GROUP BY 1)
SELECT "group", count(primer) AS n_primers FROM g JOIN hits ON hits.targets = g.members GROUP BY 1""")
def diagnostic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.diagnostic_counts(classify_exact_set(spark, sf_dir))


@registered(f"""
WITH {T.EDGES}, {T.LABELS_SQL}, g AS (SELECT "group", list_sort(list(DISTINCT m)) AS members FROM (SELECT "group", unnest(members) AS m FROM labels_t) GROUP BY 1)
SELECT "group" AS "Group", count(primer) AS "NumPrimers", 'out/' || "group" || '_primers.json' AS "Primers" FROM g LEFT JOIN hits ON hits.targets = g.members GROUP BY 1""")
def write_classification_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.classification_summary(C.process_groups(T.labels(spark)), classify_exact_set(spark, sf_dir), "out")


@registered(f'WITH {T.MANIFEST} SELECT "group", string_agg(name, \',\' ORDER BY name) AS members FROM (SELECT DISTINCT unnest(groups) AS "group", name FROM man) GROUP BY 1')
def process_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.process_groups(T.manifest(spark, sf_dir)).select("group", F.array_join("members", ",").alias("members"))


@registered(f"WITH {T.EDGES} SELECT primer, array_to_string(targets, ',') AS targets FROM hits")
def process_crosshyb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.process_crosshyb(*T.edge_rows(spark, sf_dir), T.LOW, T.HIGH).select("primer", F.array_join("targets", ",").alias("targets"))


@registered(f"WITH {T.EDGES} SELECT primer, target FROM edges")
def edges_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.edges(*T.edge_rows(spark, sf_dir), T.LOW, T.HIGH)


@registered(f"SELECT o_orderkey AS ord, o_totalprice AS length FROM orders WHERE o_totalprice > {T.LOW} AND o_totalprice < {T.HIGH}")
def amplimer_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.amplimer_length_filter(T.edge_rows(spark, sf_dir)[1], T.LOW, T.HIGH).select("ord", "length")


@registered("""SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS n FROM documents) WHERE n = 1""")
def dedupe_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.read(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").alias("name"), F.col("source").alias("sourcename"), F.col("text").alias("forward_seq"), F.lit("").alias("reverse_seq"))
    return C.dedupe_primers(rows).select(F.col("name").alias("doc_id"), F.col("forward_seq").alias("text"))


@registered(f"""WITH {T.PRIMERS} SELECT name, sourcename, forward_seq, reverse_seq FROM
  (SELECT *, row_number() OVER (PARTITION BY forward_seq, reverse_seq ORDER BY sourcename, name) AS n FROM primers) WHERE n = 1""")
def dedupe_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.dedupe_primers(T.primers(spark, sf_dir)).select("name", "sourcename", "forward_seq", "reverse_seq")


@registered(f"""WITH {T.PRIMERS} SELECT sourcename, sum((n = 1)::INT)::BIGINT AS kept, sum((n > 1)::INT)::BIGINT AS removed FROM
  (SELECT *, row_number() OVER (PARTITION BY forward_seq, reverse_seq ORDER BY sourcename, name) AS n FROM primers) GROUP BY 1""")
def dedupe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.dedupe_counts(T.primers(spark, sf_dir))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = T.read(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("m"), F.col("l_partkey").cast("string"), F.lit("_fwd")).alias("query"), F.col("l_quantity").alias("length"))


@registered("SELECT DISTINCT 'm' || l_partkey AS name FROM lineitem WHERE l_quantity > 45")
def primer_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.hit_primers(_hits(spark, sf_dir), 45)


@registered("SELECT 'm' || p_partkey AS name, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def screen_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.read(spark, sf_dir, "part").select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("name"), "p_name")
    return C.primer_screen_anti(p, _hits(spark, sf_dir), 45)


@registered("SELECT o_orderkey AS ord, o_custkey AS primer_name FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def amplimers_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = T.read(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("primer"))
    return C.amplimers_semi(T.edge_rows(spark, sf_dir)[1], rich).select("ord", "primer_name")


@registered("SELECT o_orderpriority AS target, count(DISTINCT o_custkey) AS n_primers, count(*) AS n_amplimers FROM orders GROUP BY 1")
def collect_amplimers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.collect_amplimers(T.edge_rows(spark, sf_dir)[1])


@registered("SELECT o_orderkey AS ord, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey)::INT AS idx FROM orders")
def number_amplimers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.number_amplimers(T.edge_rows(spark, sf_dir)[1], ["ord"]).select("ord", "idx")


@registered("SELECT o_custkey AS name, o_orderkey AS ord, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def top_n_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("name"), F.col("o_orderkey").alias("ord"), (-F.col("o_totalprice")).alias("penalty"))
    return D.top_n(rows, "name", ["penalty", "ord"], 3).select("name", "ord", "rank")


# Manifest


@registered(f'WITH {T.MANIFEST} SELECT DISTINCT unnest(groups) AS "group" FROM man')
def groups_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.distinct_groups(T.manifest(spark, sf_dir))


@registered(f"WITH {T.MANIFEST} SELECT name, seqfile FROM man WHERE list_contains(groups, 'EUROPE')")
def groups_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.group_members(T.manifest(spark, sf_dir), "EUROPE", must_exist=False).select("name", "seqfile")


@registered("SELECT o_custkey AS name, last(o_orderkey ORDER BY o_orderkey) AS seqfile FROM orders GROUP BY 1")
def manifest_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("name"), F.col("o_orderkey").alias("seqfile"), F.col("o_orderkey").alias("ord"))
    return M.manifest_last_wins(o)


@registered(f"WITH {T.MANIFEST} SELECT name, array_to_string(list_sort(list_distinct(list_concat(groups, ['new', 'odd']))), ',') AS groups FROM man")
def groups_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = T.manifest(spark, sf_dir)
    return m.select("name", F.array_join(M.groups_union(F.col("groups"), M.labels_of(F.lit("new,odd"))), ",").alias("groups"))


@registered(f"WITH {T.MANIFEST} SELECT name || chr(9) || array_to_string(groups, ',') || chr(9) || seqfile || chr(9) || coalesce(features, '-') AS value FROM man")
def write_manifest_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.manifest_tab(T.manifest(spark, sf_dir)).select("value")


@registered(f"WITH {T.MANIFEST} SELECT name, array_to_string(groups, ',') AS groups, seqfile, features, name AS filestem FROM man")
def scan_manifest_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest written and read back."""
    path = T.scratch(spark, "manifest") + ".tab"
    W.write_manifest_tab(T.manifest(spark, sf_dir), path)
    return R.scan_manifest_tab(spark, path).select("name", F.array_join("groups", ",").alias("groups"), "seqfile", "features", "filestem")


@registered(f"WITH {T.MANIFEST} SELECT 'every' AS column_of, bool_and(seqfile IS NOT NULL) AS complete FROM man UNION ALL SELECT 'some', bool_and(features IS NOT NULL) FROM man")
def has_primersearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a report for every genome, and with one only for those that have features."""
    m = T.manifest(spark, sf_dir)
    every, some = (M.has_primersearch(m.withColumn("primersearch", F.col(c))) for c in ("seqfile", "features"))
    return every.select(F.lit("every").alias("column_of"), "complete").union(some.select(F.lit("some"), "complete"))


@registered(f"WITH {T.MANIFEST} SELECT count(*) AS genomes, (SELECT count(DISTINCT g) FROM (SELECT unnest(groups) AS g FROM man)) AS labels FROM man")
def count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.count(T.manifest(spark, sf_dir))


@registered("SELECT s_name AS stem FROM supplier WHERE s_suppkey % 2 = 1 OR s_suppkey % 10 = 0")
def pending_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of every other genome are written, those of every tenth broken: the rest is to do."""
    s = T.read(spark, sf_dir, "supplier")
    text = F.when(F.col("s_suppkey") % 10 == 0, F.lit('{"pairs": [1, 2')).otherwise(F.lit('{"pairs": [1, 2]}'))
    path = T.scratch(spark, "outputs")
    rows = s.where("s_suppkey % 2 = 0").select(F.concat("s_name", F.lit(".eprimer3")).alias("output"), text.alias("value"))
    W.filed(W.by_file(rows, "output"), "output").text(path)
    return N.pending(s.select(F.col("s_name").alias("stem")), N.outputs(spark, path), "eprimer3", "stem")


@registered(f"WITH {T.MANIFEST} SELECT name FROM man WHERE features IS NOT NULL AND name NOT IN (SELECT s_name FROM supplier WHERE s_suppkey % 2 = 0)")
def check_required_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = T.read(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("in/"), "s_name", F.lit(".fasta")).alias("path"))
    return M.missing_paths(T.manifest(spark, sf_dir), "features", there).select("name")


@registered("SELECT a.n_name AS a, b.n_name AS b, a.n_regionkey FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name")
def pairwise_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pairwise_permutations(T.read(spark, sf_dir, "nation"), "n_name", "n_regionkey")


@registered("SELECT a.s_name AS query, b.n_name AS target FROM supplier a, nation b")
def all_vs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = T.read(spark, sf_dir, "supplier").withColumnRenamed("s_name", "name"), T.read(spark, sf_dir, "nation").withColumnRenamed("n_name", "name")
    return M.all_vs_all(s, n)


@registered("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pending_work(T.read(spark, sf_dir, "documents").select("doc_id", "source"), T.read(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@registered(f"WITH {T.MANIFEST} SELECT name, CASE WHEN features IS NOT NULL THEN features || '.f' ELSE seqfile END AS design, regexp_replace(regexp_extract(seqfile, '[^/]*$'), '\\.[^.]*$', '') || '.primer3' AS output FROM man")
def choose_design_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = T.manifest(spark, sf_dir).withColumn("filtered_seqfile", F.concat("features", F.lit(".f")))
    return m.select("name", M.design_sequence(True).alias("design"), M.output_name("primer3", S.filestem(F.col("seqfile"))).alias("output"))


# Intervals

_ISLANDS = """m0 AS (SELECT chrom, {part}, "start", "end", max("end") OVER (PARTITION BY chrom, {part} ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM {src}),
m1 AS (SELECT *, sum((b IS NULL OR "start" > b)::INT) OVER (PARTITION BY chrom, {part} ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS id FROM m0),
merged AS (SELECT chrom, {part}, min("start") AS "start", max("end") AS "end" FROM m1 GROUP BY chrom, {part}, id)"""


@registered(f"WITH {T.INTERVALS}, {_ISLANDS.format(part='part', src='(SELECT *, 0 AS part FROM iv)')} SELECT chrom, \"start\", \"end\" FROM merged")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.interval_merge(T.intervals(spark, sf_dir))


@registered(f"""WITH {T.INTERVALS}, {_ISLANDS.format(part='part', src='(SELECT *, 0 AS part FROM iv)')},
len AS (SELECT DISTINCT chrom, 1735689600 AS length FROM iv), e AS (SELECT chrom, "start", "end" FROM merged UNION ALL SELECT chrom, length, length FROM len),
gaps AS (SELECT chrom, coalesce(lag("end") OVER (PARTITION BY chrom ORDER BY "start", "end"), 0) AS "start", "start" AS "end" FROM e)
SELECT chrom, "start"::BIGINT AS "start", "end"::BIGINT AS "end" FROM gaps WHERE "start" < "end" """)
def interval_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = T.intervals(spark, sf_dir)
    return I.interval_complement(iv, iv.select("chrom").distinct().withColumn("length", F.lit(1735689600).cast("long")))


@registered(f"""WITH {T.INTERVALS}, {_ISLANDS.format(part='part', src='(SELECT *, 0 AS part FROM iv)')} SELECT chrom, count(*) AS regions, sum("end" - "start")::BIGINT AS covered FROM merged GROUP BY 1""")
def interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.interval_coverage(I.interval_merge(T.intervals(spark, sf_dir)))


_DEPTH = """pts AS (SELECT DISTINCT chrom, pt FROM (SELECT chrom, "start" AS pt FROM merged UNION ALL SELECT chrom, "end" FROM merged)),
seg AS (SELECT chrom, pt AS s, lead(pt) OVER (PARTITION BY chrom ORDER BY pt) AS e FROM pts),
dep AS (SELECT seg.chrom, s AS "start", e AS "end", 0 AS p2 FROM seg JOIN merged m ON m.chrom = seg.chrom AND m."start" <= s AND m."end" >= e WHERE e IS NOT NULL GROUP BY 1, 2, 3 HAVING {having}),
f0 AS (SELECT chrom, p2, "start", "end", max("end") OVER (PARTITION BY chrom ORDER BY "start" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM dep),
f1 AS (SELECT *, sum((b IS NULL OR "start" > b)::INT) OVER (PARTITION BY chrom ORDER BY "start" ROWS UNBOUNDED PRECEDING) AS id FROM f0)
SELECT chrom, min("start") AS "start", max("end") AS "end" FROM f1 GROUP BY chrom, id"""
_THREE = """iv3 AS (SELECT chrom, "start", "end", CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 ELSE 2 END AS part FROM iv)"""


def _three(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    iv = T.intervals(spark, sf_dir)
    return [iv.where("event_type = 'click'"), iv.where("event_type = 'error'"), iv.where("event_type not in ('click', 'error')")]


@registered(f"WITH {T.INTERVALS}, {_THREE}, {_ISLANDS.format(part='part', src='iv3')}, {_DEPTH.format(having='max((m.part = 0)::INT) = 1 AND max(m.part) > 0')}")
def interval_intersect_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, *others = _three(spark, sf_dir)
    return I.interval_intersect_any(first, others)


@registered(f"WITH {T.INTERVALS}, {_THREE}, {_ISLANDS.format(part='part', src='iv3')}, {_DEPTH.format(having='count(DISTINCT m.part) = 3')}")
def interval_intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.interval_intersect_all(_three(spark, sf_dir))


@registered(f"""WITH {T.INTERVALS}, good AS (SELECT chrom, "start", "end", CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 ELSE 2 END AS part FROM iv WHERE event_id % 7 >= 2),
{_ISLANDS.format(part='part', src='good')}, {_DEPTH.format(having='max((m.part = 0)::INT) = 1 AND max(m.part) > 0').replace('SELECT chrom, min(', 'SELECT chrom AS query, min(')}""")
def common_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.common_regions(_asked(spark, sf_dir), min_sim_errors=2)


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as genomes, events as their alignments to one of three kinds."""
    kind = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "error", 1).otherwise(2)
    iv = T.intervals(spark, sf_dir).select(F.col("chrom").alias("query"), kind.alias("subject"), "start", "end", (F.col("event_id") % 7).alias("sim_errors"))
    every = iv.select("query").distinct().crossJoin(spark.range(3).select(F.col("id").cast("int").alias("subject")))
    # Each user is asked for all three kinds, with or without events of that kind.
    asked = every.join(iv.select("query", "subject").distinct(), ["query", "subject"], "left_anti").select("query", "subject", F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("sim_errors"))
    return iv.union(asked)


@registered(f"""WITH {T.INTERVALS}, good AS (SELECT chrom, "start", "end", CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 ELSE 2 END AS part FROM iv WHERE event_id % 7 >= 2),
{_ISLANDS.format(part='part', src='good')}, {_DEPTH.format(having='count(DISTINCT m.part) = 3').replace('SELECT chrom, min(', 'SELECT chrom AS query, min(')}""")
def common_regions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.common_regions(_asked(spark, sf_dir), min_sim_errors=2, mode="all")


@registered(f"""WITH {T.INTERVALS} SELECT event_id, greatest(0, "start" - 500)::BIGINT AS "start", least(1735689600, "end" + 500)::BIGINT AS "end" FROM iv""")
def feature_flank(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = T.intervals(spark, sf_dir)
    wide = I.feature_flank(iv, iv.select("chrom").distinct().withColumn("length", F.lit(1735689600).cast("long")), 500)
    return wide.select("event_id", "start", "end")


@registered(f"""WITH {T.INTERVALS} SELECT event_id FROM iv WHERE event_id % 50 >= 10 AND (event_id % 50)::DOUBLE / ("end" - "start") >= 0.005""")
def alignment_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = T.intervals(spark, sf_dir).withColumn("sim_errors", F.col("event_id") % 50)
    return I.alignment_quality_filter(iv, 10, 0.005).select("event_id")


# Sequences

_STITCH = "string_agg(seq, '{sep}' ORDER BY ord)"


@registered(f"""WITH {T.SEQUENCES} SELECT name, count(*) > 1 AS stitched, CASE WHEN count(*) > 1 THEN name || '_concatenated' ELSE min(seq_id) END AS seq_id,
length({_STITCH.format(sep=S.SPACER)})::INT AS length, md5({_STITCH.format(sep=S.SPACER)}) AS digest FROM seqs GROUP BY name""")
def stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Q.stitch(T.sequences(spark, sf_dir))
    return s.select("name", "stitched", "seq_id", F.length("seq").alias("length"), F.md5("seq").alias("digest"))


@registered(f"WITH {T.SEQUENCES} SELECT name, count(*) AS n_records, count(*) > 1 AS requires_stitch, bool_or(regexp_matches(seq, '{S.AMBIGUOUS}')) AS has_ambiguities FROM seqs GROUP BY 1")
def validate_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.validate_manifest(T.sequences(spark, sf_dir))


_BY_LANG = f"s2 AS (SELECT name || '_' || coalesce(description, '') || '_' || (ord % 10) AS name, seq_id, ord, seq FROM seqs)"


@registered(f"""WITH {T.SEQUENCES}, {_BY_LANG}, a AS (SELECT *, bool_or(regexp_matches(seq, '{S.AMBIGUOUS}')) OVER (PARTITION BY name) AS replaced FROM s2)
SELECT CASE WHEN replaced THEN seq_id || '_noambig' ELSE seq_id END AS seq_id, replaced, md5(CASE WHEN replaced THEN regexp_replace(seq, '{S.AMBIGUOUS}', 'N', 'g') ELSE seq END) AS digest FROM a""")
def replace_ambiguities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.sequences(spark, sf_dir).withColumn("name", F.concat_ws("_", "name", F.coalesce("description", F.lit("")), (F.col("ord") % 10).cast("string")))
    return Q.replace_ambiguities(s).select("seq_id", "replaced", F.md5("seq").alias("digest"))


@registered(f"""WITH {T.SEQUENCES}, st AS (SELECT name, {_STITCH.format(sep=S.SPACER)} AS seq FROM seqs GROUP BY name)
SELECT name, md5(CASE WHEN regexp_matches(seq, '{S.AMBIGUOUS}') THEN regexp_replace(seq, '{S.AMBIGUOUS}', 'N', 'g') ELSE seq END) AS digest FROM st""")
def fix_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.fix_sequences(T.sequences(spark, sf_dir)).select("name", F.md5("seq").alias("digest"))


_CUT = "SELECT name, {cols}t AS tile, md5(substr(seq, (t * 10000 + 1)::INT, 10000)) AS digest FROM (SELECT *, unnest(range(0, greatest(1, (length(seq) + 9999) // 10000))) AS t FROM {src})"


@registered(f"""WITH {T.SEQUENCES}, st AS (SELECT name, count(*) > 1 AS stitched, {_STITCH.format(sep=S.SPACER)} AS seq FROM seqs GROUP BY name)
{_CUT.format(cols="stitched, ", src="st")}""")
def stitch_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.stitch(T.tiles(spark, sf_dir)).select("name", "stitched", "tile", F.md5("seq").alias("digest"))


@registered(f"""WITH {T.SEQUENCES}, {T.REGIONS}, r AS (SELECT name, string_agg(substr(seq, a + 1, (b - a)::INT), '{"N" * 150}' ORDER BY ord, w) AS seq FROM regs GROUP BY name)
{_CUT.format(cols="", src="r")}""")
def filtered_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.filtered(T.tiles(spark, sf_dir), T.regions(T.sequences(spark, sf_dir)), flank=5).select("name", "tile", F.md5("seq").alias("digest"))


@registered(f"WITH {T.SEQUENCES} SELECT seq_id, length(seq)::INT AS length FROM seqs")
def genome_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.genome_lengths(T.sequences(spark, sf_dir))


@registered(f"WITH {T.SEQUENCES} SELECT seq_id, md5(reverse(translate(seq, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN'))) AS digest FROM seqs")
def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.sequences(spark, sf_dir).select("seq_id", F.md5(S.reverse_complement(F.col("seq"))).alias("digest"))


@registered(f"""WITH {T.SEQUENCES}, g AS (SELECT seq_id, seq AS s FROM seqs), c AS (SELECT *, length(regexp_replace(s, '[^GC]', '', 'g')) AS gc, length(regexp_replace(s, '[^AT]', '', 'g')) AS nat, length(s) AS n FROM g)
SELECT seq_id, CASE WHEN n > 0 THEN round(100.0 * gc / n, 6) ELSE 0.0 END::DOUBLE AS gc, round(CASE WHEN n < 14 THEN 2.0 * nat + 4.0 * gc ELSE 64.9::DOUBLE + 41.0::DOUBLE * (gc - 16.4::DOUBLE) / n END, 6)::DOUBLE AS tm, regexp_matches(s, 'A{{4}}|C{{4}}|G{{4}}|T{{4}}') AS has_run FROM c""")
def gc_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("seq")
    return T.sequences(spark, sf_dir).select("seq_id", F.round(S.gc_percent(s), 6).alias("gc"), F.round(S.melting_temp(s), 6).alias("tm"), S.has_run(s, 3).alias("has_run"))


@registered(f"""WITH {T.SEQUENCES}, k AS (SELECT substr(seq, i::INT, 6) AS kmer FROM (SELECT seq, unnest(range(1, length(seq) - 4)) AS i FROM seqs WHERE length(seq) >= 6))
SELECT kmer, count(*) AS n FROM k WHERE NOT contains(kmer, 'N') GROUP BY 1""")
def kmer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.word_counts(T.sequences(spark, sf_dir), 6)


@registered("SELECT doc_id, regexp_extract(source || '/' || lang || '.' || doc_id || '.fasta', '([^/]*)\\.[^.]*$', 1) AS stem, source AS sourcename, printf('%s_primer_%05d', source, doc_id) AS name FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.read(spark, sf_dir, "documents").where("lang is not null and source is not null")
    path = F.concat("source", F.lit("/"), "lang", F.lit("."), F.col("doc_id").cast("string"), F.lit(".fasta"))
    return d.select("doc_id", S.filestem(path).alias("stem"), F.col("source").alias("sourcename"), F.format_string("%s_primer_%05d", "source", "doc_id").alias("name"))


# Amplicons and diversity


@registered(f"""WITH {T.SEQUENCES}, p AS (SELECT *, CASE WHEN ord % 2 = 0 THEN 'x' ELSE 'y' END AS fwd, w * 400 + 11 AS a, w * 400 + 11 + 40 + ord % 300 AS b
  FROM (SELECT *, unnest(range(0, length(seq) // 400 + 1)) AS w FROM seqs)),
c AS (SELECT *, substr(seq, a::INT, (b - a + 1)::INT) AS s FROM p)
SELECT 'm' || ord AS primer, 'm' || ord || '_' || seq_id || '_' || (w + 1) AS amplicon_name, md5(CASE WHEN fwd = 'x' THEN s ELSE reverse(translate(s, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) END) AS digest
FROM c WHERE length(s) > 50 AND length(s) < 300""")
def extract_amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amplimers at every 400th base of each text."""
    s = T.sequences(spark, sf_dir)
    name = F.concat(F.lit("m"), F.col("ord").cast("string")).alias("primer_name")
    at = s.select(name, F.col("seq_id").alias("target"), "ord", F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / 400).cast("int"))).alias("w"))
    amps = at.select("primer_name", "target", (F.col("w") + 1).alias("idx"), F.lit("x").alias("fwd_seq"), (F.col("w") * 400 + 11).alias("fwd_start"), (F.col("w") * 400 + 51 + F.col("ord") % 300).alias("rev_end"))
    pairs = s.select(name.alias("name"), F.when(F.col("ord") % 2 == 0, "x").otherwise("y").alias("forward_seq"))
    out = V.extract_amplicons(amps, pairs, T.tiles(spark, sf_dir).select(F.col("seq_id").alias("name"), "tile", "seq"))
    return out.select("primer", "amplicon_name", F.md5("seq").alias("digest"))


_PAIRS = "prs AS (SELECT a.primer, a.amplicon_name AS a, b.amplicon_name AS b, hamming(a.seq, b.seq)::DOUBLE / length(a.seq) AS dist FROM amps a JOIN amps b ON a.primer = b.primer AND a.amplicon_name < b.amplicon_name)"
_SHANNON = """cnt AS (SELECT primer, seq, count(*) AS c FROM amps GROUP BY 1, 2),
sh AS (SELECT primer, count(*) AS n_unique, (sum(c) - count(*))::BIGINT AS n_nonunique, CASE WHEN count(*) > 1 THEN ln(sum(c)) - sum(c * ln(c)) / sum(c) ELSE 0 END AS h FROM cnt GROUP BY 1)"""


@registered(f"WITH {T.AMPLICONS}, {_PAIRS} SELECT primer, a, b, round(dist, 6) AS dist FROM prs")
def identity_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pair_distances(T.amplicons(spark, sf_dir)).withColumn("dist", F.round("dist", 6))


@registered(f"WITH {T.AMPLICONS} SELECT a.primer, a.amplicon_name AS a, b.amplicon_name AS b, round(levenshtein(a.seq, b.seq) / greatest(length(a.seq), length(b.seq)), 6) AS dist FROM amps a JOIN amps b ON a.primer = b.primer AND a.amplicon_name < b.amplicon_name")
def amplicon_edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pair_distances(T.amplicons(spark, sf_dir), aligned=False).withColumn("dist", F.round("dist", 6))


@registered(f"""WITH {T.AMPLICONS}, {_PAIRS}, {_SHANNON}, st AS (SELECT primer, avg(dist) AS m, stddev_samp(dist) AS s, min(dist) AS lo, max(dist) AS hi FROM prs GROUP BY 1)
SELECT sh.primer, round(coalesce(m, 0), 6) AS dist_mean, round(coalesce(s, 0), 6) AS dist_sd, round(coalesce(lo, 0), 6) AS dist_min, round(coalesce(hi, 0), 6) AS dist_max, n_unique, n_nonunique,
round(h, 6)::DOUBLE AS shannon, round(CASE WHEN n_unique > 1 THEN h / ln(n_unique) ELSE 0 END, 6)::DOUBLE AS evenness FROM sh LEFT JOIN st ON sh.primer = st.primer""")
def distance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.pairwise_distance_stats(T.amplicons(spark, sf_dir))
    return s.select("primer", *[F.round(c, 6).alias(c) for c in ("dist_mean", "dist_sd", "dist_min", "dist_max")], "n_unique", "n_nonunique", F.round("shannon", 6).alias("shannon"), F.round("evenness", 6).alias("evenness"))


@registered(f"WITH {T.AMPLICONS}, {_SHANNON} SELECT primer, n_unique, n_nonunique, round(h, 6)::DOUBLE AS shannon, round(CASE WHEN n_unique > 1 THEN h / ln(n_unique) ELSE 0 END, 6)::DOUBLE AS evenness FROM sh")
def shannon_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.shannon_index(T.amplicons(spark, sf_dir))
    return s.select("primer", "n_unique", "n_nonunique", F.round("shannon", 6).alias("shannon"), F.round("evenness", 6).alias("evenness"))


@registered(f"WITH {T.AMPLICONS} SELECT primer, count(DISTINCT seq) AS n_unique, count(*) - count(DISTINCT seq) AS n_nonunique FROM amps GROUP BY 1")
def unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.unique_counts(T.amplicons(spark, sf_dir))


@registered(f"WITH {T.AMPLICONS} SELECT primer, amplicon_name, seq FROM amps WHERE primer IN (SELECT primer FROM amps GROUP BY 1 HAVING count(*) = 1)")
def single_sequence_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.single_sequence_passthrough(T.amplicons(spark, sf_dir))


_STATS = f"""{T.AMPLICONS}, {_PAIRS}, {_SHANNON}, st AS (SELECT primer, round(avg(dist), 6) AS m FROM prs GROUP BY 1),
stats AS (SELECT sh.primer, n_unique, n_nonunique, coalesce(m, 0) AS dist_mean FROM sh LEFT JOIN st ON sh.primer = st.primer)"""


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pairwise_distance_stats(T.amplicons(spark, sf_dir)).withColumn("dist_mean", F.round("dist_mean", 6))


@registered(f"WITH {_STATS} SELECT primer AS label, n_nonunique AS x, dist_mean AS y, round((SELECT max(n_unique) * 1.2::DOUBLE FROM stats), 6)::DOUBLE AS x_max, round((SELECT max(dist_mean) * 1.2::DOUBLE FROM stats), 6)::DOUBLE AS y_max, -0.1::DOUBLE AS x_min, -0.01::DOUBLE AS y_min FROM stats")
def marker_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.marker_scatter(_stats(spark, sf_dir))
    return s.withColumn("x_max", F.round(F.col("x_max").cast("double"), 6)).withColumn("y_max", F.round("y_max", 6))


@registered(f"WITH {_STATS} SELECT primer, n_nonunique, dist_mean FROM stats s WHERE NOT EXISTS (SELECT 1 FROM stats o WHERE o.n_nonunique <= s.n_nonunique AND o.dist_mean >= s.dist_mean AND (o.n_nonunique < s.n_nonunique OR o.dist_mean > s.dist_mean))")
def marker_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.marker_pareto(_stats(spark, sf_dir)).select("primer", "n_nonunique", "dist_mean")


#: Values have six decimals here; 1e-9 more makes ties of the fourth and second go up, as in the library's format.
_SUMMARY = f"""{T.AMPLICONS}, {_PAIRS}, {_SHANNON}, st AS (SELECT primer, round(avg(dist), 6) AS m, round(stddev_samp(dist), 6) AS sd, round(min(dist), 6) AS lo, round(max(dist), 6) AS hi FROM prs GROUP BY 1),
summary AS (SELECT sh.primer, coalesce(m, 0)::DOUBLE AS dist_mean, coalesce(sd, 0)::DOUBLE AS dist_sd, coalesce(lo, 0)::DOUBLE AS dist_min, coalesce(hi, 0)::DOUBLE AS dist_max, n_unique AS "unique", n_nonunique AS nonunique,
  round(h, 6)::DOUBLE AS shannon_index, round(CASE WHEN n_unique > 1 THEN h / ln(n_unique) ELSE 0 END, 6)::DOUBLE AS shannon_evenness FROM sh LEFT JOIN st ON sh.primer = st.primer)"""


def _rounded_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pairwise_distance_stats(T.amplicons(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("dist_mean", "dist_sd", "dist_min", "dist_max", "shannon", "evenness")})


@registered(f"""WITH {_SUMMARY} SELECT primer, printf('%.4f', dist_mean + 1e-9) AS dist_mean, printf('%.4f', dist_sd + 1e-9) AS dist_sd, printf('%.4f', dist_min + 1e-9) AS dist_min, printf('%.4f', dist_max + 1e-9) AS dist_max, "unique", nonunique,
printf('%.2f', shannon_index + 1e-9) AS shannon_index, printf('%.2f', shannon_evenness + 1e-9) AS shannon_evenness FROM summary""")
def write_distance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.distance_summary(_rounded_stats(spark, sf_dir))


# Matching

_KMERS = "SELECT {cols}, substr(seq, i::INT, {k}) AS kmer FROM (SELECT *, unnest(range(1, length(seq) - {k} + 2)) AS i FROM {src} WHERE length(seq) >= {k})"


@registered(f"""WITH {T.SEQUENCES}, b AS (SELECT {T.SEQ_SQL} AS seq FROM benchmark), b2 AS (SELECT seq FROM b UNION ALL SELECT reverse(translate(seq, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) FROM b),
kb AS ({_KMERS.format(cols='1', k=25, src='b2')}), ks AS ({_KMERS.format(cols='seq_id', k=25, src='seqs')})
SELECT DISTINCT seq_id AS name FROM ks WHERE NOT contains(kmer, 'N') AND kmer IN (SELECT kmer FROM kb)""")
def offtarget_kmer_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.read(spark, sf_dir, "benchmark").select(T.as_sequence(F.col("text")).alias("seq"))
    return H.offtarget_hits(T.sequences(spark, sf_dir).select(F.col("seq_id").alias("name"), "seq"), b, 24)


@registered(f"""WITH {T.PRIMERS}, b AS (SELECT {T.SEQ_SQL} AS seq FROM benchmark), b2 AS (SELECT seq FROM b UNION ALL SELECT reverse(translate(seq, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) FROM b),
kb AS ({_KMERS.format(cols='1', k=16, src='b2')}), o AS (SELECT name, forward_seq AS seq FROM primers UNION ALL SELECT name, reverse_seq FROM primers), ks AS ({_KMERS.format(cols='name', k=16, src='o')})
SELECT name FROM primers WHERE name NOT IN (SELECT name FROM ks WHERE NOT contains(kmer, 'N') AND kmer IN (SELECT kmer FROM kb))""")
def screen_offtarget(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.read(spark, sf_dir, "benchmark").select(T.as_sequence(F.col("text")).alias("seq"))
    return H.screen_offtarget(T.primers(spark, sf_dir), b, 15).select("name")


_ARM = "query, minus, seq_id, shift, a"
_GROWN = """{side}1 AS (SELECT *, sum(CASE WHEN hit THEN 1 ELSE -3 END) OVER (PARTITION BY {arm} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS sc FROM m WHERE {part}),
{side}2 AS (SELECT *, greatest(0, max(sc) OVER (PARTITION BY {arm} ORDER BY {order} ROWS UNBOUNDED PRECEDING)) - sc AS fall FROM {side}1),
{side}3 AS (SELECT *, max(fall) OVER (PARTITION BY {arm} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS deepest FROM {side}2),
{side} AS (SELECT {arm}, arg_max({far}, sc * 1000 - {far}) AS far FROM {side}3 WHERE deepest <= 10 AND sc > 0 GROUP BY ALL)"""
_HITS = f"""b AS (SELECT item_id::VARCHAR AS seq_id, {T.SEQ_SQL} AS seq FROM benchmark),
o AS (SELECT name || '_fwd' AS query, forward_seq AS s FROM primers UNION ALL SELECT name || '_rev', reverse_seq FROM primers),
o2 AS (SELECT query, false AS minus, s FROM o UNION ALL SELECT query, true, reverse(translate(s, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) FROM o),
sd AS (SELECT query, minus, s, a, substr(s, (a + 1)::INT, 11) AS kmer FROM (SELECT *, unnest(range(0, length(s) - 10)) AS a FROM o2)),
dw AS (SELECT seq_id, seq, p, substr(seq, (p + 1)::INT, 11) AS kmer FROM (SELECT *, unnest(range(0, length(seq) - 10)) AS p FROM b WHERE length(seq) >= 11)),
h AS (SELECT query, minus, s, seq_id, seq, p - a AS shift, a FROM sd JOIN dw USING (kmer) WHERE regexp_matches(kmer, '^[ACGT]+$')),
m AS (SELECT {_ARM}, length(s) AS n, i, shift + i >= 0 AND substr(seq, greatest(shift + i + 1, 1)::INT, 1) = substr(s, (i + 1)::INT, 1) AND substr(s, (i + 1)::INT, 1) IN ('A', 'C', 'G', 'T') AS hit
  FROM (SELECT *, unnest(range(0, length(s))) AS i FROM h)),
{_GROWN.format(side="r", arm=_ARM, order="i", part="i >= a + 11", far="(i - a - 10)")},
{_GROWN.format(side="l", arm=_ARM, order="i DESC", part="i < a", far="(a - i)")},
e AS (SELECT {_ARM}, n, a - coalesce(l.far, 0) AS f, a + 11 + coalesce(r.far, 0) AS t FROM (SELECT DISTINCT {_ARM}, n FROM m) LEFT JOIN l USING ({_ARM}) LEFT JOIN r USING ({_ARM})),
g AS (SELECT DISTINCT query, minus, seq_id, shift, n, f, t, matched FROM (SELECT {_ARM}, e.n, f, t, count(*) FILTER (hit AND i >= f AND i < t) AS matched FROM e JOIN m USING ({_ARM}) GROUP BY ALL)),
bits AS (SELECT *, (1.374::DOUBLE * (4 * matched - 3 * (t - f)) - ln(0.711::DOUBLE)) / ln(2.0::DOUBLE) AS bits FROM g),
aligned AS (SELECT query, seq_id AS subject, round(100.0::DOUBLE * matched / (t - f), 3) AS pident, (t - f)::INT AS length, (t - f - matched)::INT AS mismatch, 0 AS gapopen,
  (CASE WHEN minus THEN n - t + 1 ELSE f + 1 END)::INT AS qstart, (CASE WHEN minus THEN n - f ELSE t END)::INT AS qend,
  (CASE WHEN minus THEN shift + t ELSE shift + f + 1 END)::BIGINT AS sstart, (CASE WHEN minus THEN shift + f + 1 ELSE shift + t END)::BIGINT AS send,
  round(n * (SELECT sum(length(seq)) FROM b)::DOUBLE * pow(2.0::DOUBLE, -bits), 6) AS evalue, round(bits, 1) AS bitscore FROM bits)"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("seq_id"), T.as_sequence(F.col("text")).alias("seq"))


@registered(f"WITH {T.PRIMERS}, {_HITS} SELECT * FROM aligned")
def offtarget_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments of all primers' oligos with the items, with mismatches."""
    found = X.hits(X.primer_oligos(T.primers(spark, sf_dir)), _items(spark, sf_dir))
    return found.withColumn("evalue", F.round("evalue", 6))


@registered(f"WITH {T.PRIMERS}, {_HITS} SELECT name FROM primers WHERE name NOT IN (SELECT regexp_replace(query, '_(fwd|rev)$', '') FROM aligned WHERE length > 15)")
def screen_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs without an alignment of more than 15 bases, mismatches included."""
    return X.screen(T.primers(spark, sf_dir), _items(spark, sf_dir)).select("name")


def _oligos(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("oligo"), T.as_sequence(F.col("text")).alias("seq"))
    return b.where(F.length("seq") >= 60).select("oligo", F.substring("seq", 21, 20).alias("seq")).where(~F.col("seq").contains("N"))


_OLIGOS = f"o AS (SELECT item_id::VARCHAR AS oligo, substr({T.SEQ_SQL}, 21, 20) AS seq FROM benchmark WHERE length({T.SEQ_SQL}) >= 60), o1 AS (SELECT * FROM o WHERE NOT contains(seq, 'N')), o2 AS (SELECT oligo, '+' AS strand, seq FROM o1 UNION ALL SELECT oligo, '-', reverse(translate(seq, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) FROM o1)"


@registered(f"""WITH {T.SEQUENCES}, {_OLIGOS}, ks AS ({_KMERS.format(cols='seq_id, i', k=20, src='seqs')})
SELECT oligo, strand, seq_id, (i - 1)::BIGINT AS pos FROM ks JOIN o2 ON o2.seq = ks.kmer""")
def search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.search_oligos(_oligos(spark, sf_dir), T.sequences(spark, sf_dir), 0.0).select("oligo", "strand", "seq_id", F.col("pos").cast("long").alias("pos"))


@registered(f"""WITH {T.SEQUENCES}, {_OLIGOS}, ks AS ({_KMERS.format(cols='seq_id, i', k=20, src='seqs')}), d AS (SELECT DISTINCT kmer FROM ks),
h AS (SELECT oligo, strand, kmer, hamming(o2.seq, kmer) AS m FROM d, o2 WHERE (substr(kmer, 1, 6) = substr(seq, 1, 6) AND NOT contains(substr(kmer, 1, 6), 'N'))
  OR (substr(kmer, 7, 6) = substr(seq, 7, 6) AND NOT contains(substr(kmer, 7, 6), 'N')) OR (substr(kmer, 13, 6) = substr(seq, 13, 6) AND NOT contains(substr(kmer, 13, 6), 'N')))
SELECT oligo, strand, seq_id, (i - 1)::BIGINT AS pos, m::INT AS mismatches FROM h JOIN ks ON h.kmer = ks.kmer WHERE m <= 2""")
def search_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.search_oligos(_oligos(spark, sf_dir), T.sequences(spark, sf_dir), 0.1).select("oligo", "strand", "seq_id", F.col("pos").cast("long").alias("pos"), "mismatches")


@registered(f"""WITH {T.SEQUENCES}, b AS (SELECT item_id::VARCHAR AS name, {T.SEQ_SQL} AS seq FROM benchmark),
arms AS (SELECT name, 'fwd' AS arm, substr(seq, 1, 20) AS o FROM b WHERE length(seq) >= 120
  UNION ALL SELECT name, 'rev', reverse(translate(substr(seq, 101, 20), 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) FROM b WHERE length(seq) >= 120),
strands AS (SELECT name, arm, '+' AS strand, o FROM arms UNION ALL SELECT name, arm, '-', reverse(translate(o, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) FROM arms),
seeds AS (SELECT *, i * 6 AS a, substr(o, (i * 6 + 1)::INT, 6) AS kmer FROM (SELECT *, unnest(range(0, 3)) AS i FROM strands)),
ks AS (SELECT seq_id, name AS target, seq, i - 1 AS p, substr(seq, i::INT, 6) AS kmer FROM (SELECT *, unnest(range(1, length(seq) - 4)) AS i FROM seqs WHERE length(seq) >= 6)),
sites AS (SELECT DISTINCT seeds.name, arm, strand, seq_id, target, p - a AS pos, substr(seq, (p - a + 1)::INT, 20) AS site, o FROM ks JOIN seeds USING (kmer)
  WHERE NOT contains(kmer, 'N') AND p >= a AND p - a + 20 <= length(seq)),
found AS (SELECT DISTINCT name, arm, strand, seq_id, target, pos FROM sites WHERE hamming(site, o) <= 2)
SELECT l.name AS primer_name, l.target, l.seq_id AS target_fasta_id, (r.pos + 20 - l.pos)::BIGINT AS length, l.arm AS fwd_oligo, (l.pos + 1)::BIGINT AS fwd_start, r.arm AS rev_oligo, (r.pos + 20)::BIGINT AS rev_end
FROM found l JOIN found r ON l.name = r.name AND l.seq_id = r.seq_id AND l.arm <> r.arm WHERE l.strand = '+' AND r.strand = '-' AND r.pos + 20 - l.pos BETWEEN 40 AND 500""".replace("at AS (", "sites AS (").replace("FROM sites WHERE", "FROM sites WHERE"))
def search_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs cut from the benchmark texts, searched in every document."""
    b = T.read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("name"), T.as_sequence(F.col("text")).alias("seq")).where(F.length("seq") >= 120)
    pairs = b.select("name", F.substring("seq", 1, 20).alias("forward_seq"), S.reverse_complement(F.substring("seq", 101, 20)).alias("reverse_seq"))
    return H.search_primers(pairs, T.sequences(spark, sf_dir), 0.1, 500)


@registered()
def search_degenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oligos of 20 bases along every item, with a code of two bases at every seventh place and one of four at every eleventh, in all documents. Sets of letters are slow in SQL:
    a test holds the search against brute force."""
    b = _items(spark, sf_dir).select("seq_id", "seq", F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / 20).cast("int"))).alias("w"))
    oligo = F.substring(F.col("seq"), F.col("w") * 20 + 1, F.lit(20))
    b = b.select(F.concat_ws("_", "seq_id", "w").alias("oligo"), oligo.alias("seq")).where((F.length("seq") == 20) & ~F.col("seq").contains("N"))
    wide = F.concat(*[F.lit("N") if i == 11 else F.translate(F.substring("seq", i, 1), "ACGT", "RYRY") if i % 7 == 0 else F.substring("seq", i, 1) for i in range(1, 21)])
    return B.search(b.withColumn("seq", wide), T.sequences(spark, sf_dir), 0.05)


@registered()
def design_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best pairs of each record of the genomes."""
    s = T.sequences(spark, sf_dir)
    return D.design_primer_pairs(s.withColumn("name", F.col("seq_id")), D.Design())


_DIAGONAL = "ref_name, qry_name, ref, qry, minus, diag"


@registered(f"""WITH {T.SEQUENCES}, w AS (SELECT name, seq_id, i - 1 AS pos, substr(seq, i::INT, 20) AS kmer FROM (SELECT *, unnest(range(1, length(seq) - 18)) AS i FROM seqs WHERE length(seq) >= 20)),
w2 AS (SELECT *, reverse(translate(kmer, 'ACGT', 'TGCA')) AS back FROM w WHERE regexp_matches(kmer, '^[ACGT]+$')),
once AS (SELECT name, least(kmer, back) AS word, min(seq_id) AS seq_id, min(pos) AS pos, bool_or(kmer > back) AS flip FROM w2 WHERE kmer <> back GROUP BY name, least(kmer, back) HAVING count(*) = 1),
anc AS (SELECT *, x - y AS diag FROM (SELECT a.name AS ref_name, b.name AS qry_name, a.seq_id AS ref, b.seq_id AS qry, a.flip <> b.flip AS minus, a.pos AS x, CASE WHEN a.flip <> b.flip THEN -(b.pos + 20) ELSE b.pos END AS y
  FROM once a JOIN once b ON a.word = b.word AND a.name < b.name)),
g AS (SELECT *, lag(x) OVER (PARTITION BY {_DIAGONAL} ORDER BY x) AS before FROM anc),
h AS (SELECT *, sum((before IS NULL OR x > before + 20)::INT) OVER (PARTITION BY {_DIAGONAL} ORDER BY x ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT ref_name, qry_name, ref, qry, minus, min(x)::BIGINT AS rs, (max(x) + 20)::BIGINT AS re, (min(x) - diag)::BIGINT AS ys, (max(x) + 20 - diag)::BIGINT AS ye FROM h GROUP BY {_DIAGONAL}, run""")
def conserved_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact segments on either strand that sources share, from words that stand once in each."""
    return G.segments(T.sequences(spark, sf_dir), 20)


@registered()
def genome_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources aligned with each other through indels, on both strands. Chains are no SQL: tests rebuild every alignment from its numbers."""
    return G.alignments(T.sequences(spark, sf_dir), 20, 60, 60)


@registered()
def conserved_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches that the records of a genome share with the benchmark texts."""
    b = T.read(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("name"), F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("seq_id"), T.as_sequence(F.col("text")).alias("seq"))
    return H.conserved_blocks(b.union(T.sequences(spark, sf_dir).select(F.col("seq_id").alias("name"), "seq_id", "seq")), queries=b)


# Formats


def _written(spark: SparkSession, primers: DataFrame, fmt: str) -> DataFrame:
    """The lines of a file of primers."""
    path = T.scratch(spark, fmt)
    W.write_primers(primers, path, fmt)
    return spark.read.text(path).select("value")


@registered(f"WITH {T.PRIMERS} SELECT name || chr(9) || forward_seq || chr(9) || reverse_seq AS value FROM primers UNION ALL SELECT '# PRIMERS' UNION ALL SELECT '# Name       FWD        REV'")
def write_primers_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, T.primers(spark, sf_dir), "tsv")


@registered(f"""WITH {T.PRIMERS} SELECT unnest(['>' || name || '_fwd', forward_seq, '>' || name || '_rev', reverse_seq]) AS value FROM primers""")
def write_primers_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, T.primers(spark, sf_dir), "fasta")


@registered(f"WITH {T.PRIMERS} SELECT source || chr(9) || '1' || chr(9) || '80' || chr(9) || name AS value FROM primers")
def write_primers_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, T.primers(spark, sf_dir).withColumn("source_id", F.col("source")), "bed")


@registered(f"WITH {T.PRIMERS} SELECT name, forward_seq, reverse_seq, 100::BIGINT AS size, 1::BIGINT AS forward_start, 81::BIGINT AS reverse_start, 59.5::DOUBLE AS forward_tm, 45.0::DOUBLE AS reverse_gc FROM primers")
def scan_primers_eprimer3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written and read back, with the names that they carry."""
    path = T.scratch(spark, "eprimer3")
    W.write_primers(T.primers(spark, sf_dir), path, "eprimer3")
    return R.scan_primers(spark, path + "/*", "eprimer3", noname=True).select("name", "forward_seq", "reverse_seq", "size", "forward_start", "reverse_start", "forward_tm", "reverse_gc")


_ROUND = "name, forward_seq, reverse_seq, sourcename, 100::BIGINT AS size, 1::BIGINT AS forward_start, 81::BIGINT AS reverse_start, 59.5::DOUBLE AS forward_tm, 45.0::DOUBLE AS reverse_gc"


@registered(f"WITH {T.PRIMERS} SELECT {_ROUND} FROM primers")
def scan_primers_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = T.scratch(spark, "primers")
    W.write_primers(T.primers(spark, sf_dir), path, "json")
    return R.scan_primers(spark, path, "json").select("name", "forward_seq", "reverse_seq", "sourcename", "size", "forward_start", "reverse_start", "forward_tm", "reverse_gc")


@registered(f"WITH {T.SEQUENCES} SELECT seq_id, md5(seq) AS digest FROM seqs WHERE seq <> ''")
def scan_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences written as FASTA lines and read back."""
    path = T.scratch(spark, "fasta")
    T.sequences(spark, sf_dir).where("seq <> ''").select(F.concat(F.lit(">"), "seq_id", F.lit(" x\n"), F.regexp_replace("seq", "(.{60})", "$1\n")).alias("value")).write.text(path)
    return R.scan_fasta(spark, path).select("seq_id", F.md5("seq").alias("digest"))


@registered(f"""WITH {T.SEQUENCES} SELECT seq_id, tile, md5(substr(seq, (tile * 10000 + 1)::INT, 10000)) AS digest
FROM (SELECT *, unnest(range(0, greatest(1, (length(seq) + 9999) // 10000))) AS tile FROM seqs)""")
def scan_fasta_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences written as lines of 60 bases and read back as tiles."""
    path = T.scratch(spark, "fasta")
    lines = F.concat(F.lit(">"), "seq_id", F.lit(" x\n"), F.regexp_replace("seq", "(.{60})", "$1\n"))
    T.sequences(spark, sf_dir).select(lines.alias("value")).write.text(path)
    return R.scan_fasta_tiles(spark, path).select("seq_id", "tile", F.md5("seq").alias("digest"))


@registered("SELECT 'm' || l_partkey || '_fwd' AS query, l_quantity::INT AS length, l_orderkey::BIGINT AS sstart FROM lineitem")
def scan_blast_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = T.read(spark, sf_dir, "lineitem")
    rows = li.select(F.concat(F.lit("m"), F.col("l_partkey").cast("string"), F.lit("_fwd")), F.lit("db"), F.lit(100.0), F.col("l_quantity").cast("int"), F.lit(0), F.lit(0), F.lit(1), F.lit(20), F.col("l_orderkey"), F.col("l_orderkey"), F.lit(0.1), F.lit(30.0))
    path = T.scratch(spark, "blast")
    rows.write.csv(path, sep="\t")
    return R.scan_blast_hits(spark, path).select("query", "length", "sstart")


def _delta(spark: SparkSession, sf_dir: str) -> str:
    """Alignment files, one for each genome: each record against its genome, with a header of its own."""
    s = T.sequences(spark, sf_dir).where("seq <> ''")
    n = F.length("seq").cast("long")
    indels = F.when(F.col("ord") % 2 == 0, F.array(F.lit(3), F.lit(-4))).otherwise(F.array().cast("array<int>")).cast("array<bigint>")
    rows = s.select(F.col("name").alias("file"), F.col("ord").alias("header_no"), F.col("ord").alias("row_no"), F.col("name").alias("ref"), F.col("seq_id").alias("qry"), n.alias("ref_length"), n.alias("qry_length"), F.lit(1).alias("ref_start"), n.alias("ref_end"), F.lit(1).alias("qry_start"), n.alias("qry_end"), (F.col("ord") % 5).alias("errors"), (F.col("ord") % 5).alias("sim_errors"), F.lit(0).alias("stops"), indels.alias("indels"))
    path = T.scratch(spark, "delta")
    W.write_delta(rows.withColumn("paths", F.concat(F.lit("in/"), "file", F.lit(".fas out/x.fas"))), path)
    return path


_DELTA = f"{T.SEQUENCES}, a AS (SELECT name, ord, length(seq) AS n FROM seqs WHERE length(seq) > 0)"


@registered(f"WITH {_DELTA} SELECT name AS ref, 'd' || ord AS qry, n::BIGINT AS ref_end, (ord % 5)::BIGINT AS sim_errors, CASE WHEN ord % 2 = 0 THEN '3,-4' ELSE '' END AS indels FROM a")
def scan_delta_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.scan_delta_full(spark, _delta(spark, sf_dir))
    return out.select("ref", "qry", "ref_end", "sim_errors", F.array_join(F.transform("indels", lambda x: x.cast("string")), ",").alias("indels"))


@registered(f"WITH {_DELTA} SELECT name AS query, 'x' AS subject, 1::BIGINT AS \"start\", n::BIGINT AS \"end\", (ord % 5)::BIGINT AS sim_errors FROM a WHERE ord % 5 >= 2 AND n > 1 AND (ord % 5)::DOUBLE / (n - 1) >= 0.002")
def scan_delta_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.scan_delta_intervals(spark, _delta(spark, sf_dir), 2, 0.002)


@registered("SELECT true AS equal, 'same' AS table UNION ALL SELECT count(*) = 0, 'moved' FROM documents WHERE length(regexp_replace(lower(text), '[^a-z]', '', 'g')) > 0")
def delta_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table against its own rows in another order, and against rows that end one base later."""
    full = R.scan_delta_full(spark, _delta(spark, sf_dir))
    same = R.delta_equal(full, full.repartition(3, "qry")).withColumn("table", F.lit("same"))
    moved = R.delta_equal(full, full.withColumn("ref_end", F.col("ref_end") + 1)).withColumn("table", F.lit("moved"))
    return same.union(moved)


@registered(f"WITH {T.MANIFEST} SELECT name, array_to_string(groups, ',') AS groups, seqfile, features, name AS filestem FROM man")
def scan_manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = T.scratch(spark, "manifest")
    W.write_manifest_json(T.manifest(spark, sf_dir), path)
    return R.scan_manifest_json(spark, path).select("name", F.array_join("groups", ",").alias("groups"), "seqfile", "features", "filestem")


@registered(f"WITH {T.MANIFEST} SELECT name, array_to_string(groups, ',') AS groups, seqfile, features FROM man")
def convert_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TSV to JSON and back again."""
    tab, js, back = (T.scratch(spark, "m") + x for x in (".tab", ".json", ".conf"))
    W.write_manifest_tab(T.manifest(spark, sf_dir), tab)
    W.convert_manifest(spark, tab, js)
    W.convert_manifest(spark, js, back)
    return R.scan_manifest_tab(spark, back).select("name", F.array_join("groups", ",").alias("groups"), "seqfile", "features")


@registered(f"WITH {T.PRIMERS} SELECT sourcename || '_primer_' || printf('%05d', row_number() OVER (PARTITION BY sourcename ORDER BY name)) AS name, forward_seq, reverse_seq, 100::BIGINT AS size, 0::BIGINT AS forward_start, 99::BIGINT AS reverse_start, sourcename FROM primers")
def scan_primers_primer3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Design output, a file for each genome, written and read back."""
    from pyspark.sql import Window

    p = T.primers(spark, sf_dir).withColumn("i", F.row_number().over(Window.partitionBy("sourcename").orderBy("name")) - 1)
    lines = F.concat_ws("\n", *[F.format_string(form, *cols) for form, cols in (
        ("PRIMER_PAIR_%d_PENALTY=0.5", ["i"]), ("PRIMER_LEFT_%d=0,20", ["i"]), ("PRIMER_RIGHT_%d=99,20", ["i"]), ("PRIMER_LEFT_%d_SEQUENCE=%s", ["i", "forward_seq"]), ("PRIMER_RIGHT_%d_SEQUENCE=%s", ["i", "reverse_seq"]), ("PRIMER_PAIR_%d_PRODUCT_SIZE=%d", ["i", "size"]),
    )])
    text = p.groupBy("sourcename").agg(F.concat_ws("\n", F.collect_list(lines)).alias("value")).withColumn("value", F.concat("value", F.lit("\n=")))
    path = T.scratch(spark, "primer3")
    text.withColumn("g", F.col("sourcename")).select("g", "value").repartition("g").write.partitionBy("g").text(path)
    out = R.scan_primers_primer3(spark, path + "/*").withColumn("g", F.regexp_extract("source", "/g=([^/]*)/", 1))
    return out.select(F.concat("g", F.lit("_primer_"), F.regexp_extract("name", "([0-9]{5})$", 1)).alias("name"), "forward_seq", "reverse_seq", "size", "forward_start", "reverse_start", F.col("g").alias("sourcename"))


@registered("SELECT o_orderpriority AS target, 'c' || o_custkey AS primer_name, o_orderkey::BIGINT AS fwd_start, o_orderkey::BIGINT + 100 AS rev_end FROM orders")
def scan_target_amplicons_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of one object for every hundred customers: their amplimers by target."""
    o = T.read(spark, sf_dir, "orders").withColumn("file", F.floor(F.col("o_custkey") / 100))
    arm = lambda s: F.array(F.lit("ACGT"), s.cast("string"), s.cast("string"))
    amp = F.struct(arm(F.col("o_orderkey")).alias("_fwd"), arm(F.col("o_orderkey") + 100).alias("_rev"), F.lit(100).alias("_len"), F.lit("Amplimer 1").alias("_name"), F.lit("s").alias("_seqname"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("primer_name"), F.lit("f").alias("target"), F.lit("s").alias("target_fasta_id"))
    rows = o.groupBy("file", "o_orderpriority").agg(F.collect_list(amp).alias("a")).groupBy("file").agg(F.map_from_arrays(F.collect_list("o_orderpriority"), F.collect_list("a")).alias("m"))
    path = T.scratch(spark, "amplicons")
    rows.select("file", F.to_json("m").alias("value")).write.partitionBy("file").text(path)
    return R.scan_target_amplicons_json(spark, path).select("target", "primer_name", F.col("fwd.start").alias("fwd_start"), F.col("rev.end").alias("rev_end"))


@registered("SELECT n_name AS target, 'r' || n_nationkey AS report FROM nation")
def scan_primersearch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = T.read(spark, sf_dir, "nation").select(F.col("n_name").alias("k"), F.concat(F.lit("r"), F.col("n_nationkey").cast("string")).alias("v"))
    rows = n.agg(F.to_json(F.map_concat(F.map_from_arrays(F.collect_list("k"), F.collect_list("v")), F.create_map(F.lit("query"), F.lit("q"), F.lit("primers"), F.lit("p")))).alias("value"))
    path = T.scratch(spark, "index")
    rows.write.text(path)
    return R.scan_primersearch_index(spark, path).select("target", "report")


@registered(f"""WITH {T.INTERVALS} SELECT 'u' || chrom AS chrom, "start", "end" FROM iv""")
def scan_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = T.intervals(spark, sf_dir)
    line = F.concat_ws("\t", F.concat(F.lit("u"), F.col("chrom").cast("string")), F.lit("x"), F.lit("CDS"), (F.col("start") + 1).cast("string"), F.col("end").cast("string"), F.lit("."), F.lit("+"), F.lit("0"), F.lit("id"))
    path = T.scratch(spark, "gff")
    iv.select(line.alias("value")).write.text(path)
    return R.scan_features(spark, path, "gff").select("chrom", "start", "end")


@registered(f"""WITH {T.INTERVALS} SELECT 'u' || chrom AS chrom, "start", "end" FROM iv""")
def scan_features_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = T.intervals(spark, sf_dir)
    line = F.concat_ws("\t", F.concat(F.lit("u"), F.col("chrom").cast("string")), F.col("start").cast("string"), F.col("end").cast("string"), F.lit("id"))
    path = T.scratch(spark, "features") + ".bed"
    iv.select(line.alias("value")).write.text(path)
    return R.scan_features(spark, path).select("chrom", "start", "end")


@registered(f"""WITH {_SUMMARY} SELECT primer, round(dist_mean, 4) AS dist_mean, round(dist_sd, 4) AS dist_sd, round(dist_min, 4) AS dist_min, round(dist_max, 4) AS dist_max,
"unique"::INT AS "unique", nonunique::INT AS nonunique, round(shannon_index, 2) AS shannon_index, round(shannon_evenness, 2) AS shannon_evenness FROM summary""")
def scan_distance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = T.scratch(spark, "distances")
    W.write_distance_summary(_rounded_stats(spark, sf_dir), path)
    return R.scan_distance_table(spark, path)


@registered(f"WITH {T.HEADS} SELECT amplicon_name AS seq_id, seq FROM amps")
def scan_alignment_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = T.scratch(spark, "aln")
    W.write_amplicon_fasta(T.heads(spark, sf_dir), path)
    return R.scan_alignment_fasta(spark, path + "/*").select("seq_id", "seq")


@registered(f"WITH {T.AMPLICONS} SELECT '>' || amplicon_name || ' Predicted diagnostic amplicon' || chr(10) || seq AS value FROM amps")
def write_amplicon_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.amplicon_fasta(T.amplicons(spark, sf_dir)).select("value")


@registered("SELECT o_orderkey || chr(9) || '1' || chr(9) || '52' || chr(9) || o_custkey AS value FROM orders")
def write_target_amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.read(spark, sf_dir, "orders")
    place = lambda a, b: F.struct(F.lit("AC").alias("seq"), F.lit(a).alias("start"), F.lit(b).alias("end"))
    amps = o.select(F.col("o_orderpriority").alias("target"), F.col("o_custkey").cast("string").alias("primer_name"), F.col("o_orderkey").cast("string").alias("target_fasta_id"), place(1, 3).alias("fwd"), place(50, 52).alias("rev"))
    return W.amplicons_bed(amps).select("value")


@registered(f"WITH {T.SEQUENCES} SELECT seq_id, length(seq)::INT AS length FROM seqs WHERE seq <> ''")
def write_bedgenome(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = T.scratch(spark, "bedgenome")
    W.write_bedgenome(T.sequences(spark, sf_dir).where("seq <> ''"), path)
    return spark.read.schema("seq_id string, length int").csv(path, sep="\t")


_REQUEST = """'NUM_RETURN=10', 'SIZE_MIN=18', 'SIZE_OPT=20', 'SIZE_MAX=22', 'WT_LT=1.0', 'WT_GT=1.0', 'TM_MIN=58.0', 'TM_OPT=59.0', 'TM_MAX=60.0', 'GC_MIN=30.0', 'GC_OPT=55.0', 'GC_MAX=80.0',
'PRODUCT_MIN=50', 'PRODUCT_OPT=100', 'PRODUCT_MAX=150', 'POLY_X=3', 'PROBE=0', 'PROBE_SIZE_MIN=13', 'PROBE_SIZE_OPT=20', 'PROBE_SIZE_MAX=30', 'PROBE_TM_MIN=68.0', 'PROBE_TM_OPT=69.0', 'PROBE_TM_MAX=70.0',
'PROBE_GC_MIN=30.0', 'PROBE_GC_OPT=55.0', 'PROBE_GC_MAX=80.0', 'NEAREST_NEIGHBOURS=0', 'SALT=0.05', 'STRANDS=5e-08', '='"""


@registered(f"SELECT s_name AS name, unnest(['SEQUENCE_ID=' || s_name, {_REQUEST}]) AS value FROM supplier")
def write_boulder_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = T.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    path = T.scratch(spark, "boulder")
    W.write_boulder_input(D.boulder_input(names), path)
    return spark.read.text(path).select("name", "value")


@registered()
def design_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best pairs of each record with a probe between them, none binding the other."""
    d = D.Design(probe=True, probe_tm_min=58.0, probe_tm_opt=62.0, probe_tm_max=66.0, max_self=8, max_self_end=5, max_pair=6, max_pair_end=4)
    return D.design_primer_pairs(T.sequences(spark, sf_dir).withColumn("name", F.col("seq_id")), d)


@registered()
def align_amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amplicons of 90 to 100 bases, aligned by primer."""
    a = T.amplicons(spark, sf_dir)
    short = F.substring(F.col("seq"), F.lit(1), (100 - F.pmod(F.xxhash64("amplicon_name"), F.lit(11))).cast("int"))
    return K.align_amplicons(a.withColumn("seq", short))


@registered(f"WITH {T.SEQUENCES}, {T.REGIONS} SELECT seq_id, a::BIGINT AS start, md5(substr(seq, a + 1, (b - a)::INT)) AS digest FROM regs")
def region_extract_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.sequences(spark, sf_dir)
    return L.regions(T.tiles(spark, sf_dir), T.regions(s), flank=5).select("seq_id", "start", F.md5("seq").alias("digest"))


@registered(f"WITH {T.PRIMERS} SELECT p.name, s.description, length(s.seq)::INT AS length FROM primers p JOIN seqs s ON p.source = s.seq_id")
def primers_to_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.sequences(spark, sf_dir).select(F.col("seq_id").alias("source"), "description", F.length("seq").alias("length"))
    return C.primers_to_source(T.primers(spark, sf_dir).select("name", "source"), s)


@registered(f"WITH {T.AMPLICONS} SELECT primer, row_number() OVER (PARTITION BY primer ORDER BY amplicon_name)::INT AS rank, amplicon_name FROM amps")
def index_by_primer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.index_by_primer(T.amplicons(spark, sf_dir))


@registered(f"WITH {T.PRIMERS} SELECT printf('%s_primer_%05d', sourcename, row_number() OVER (PARTITION BY sourcename ORDER BY name)) AS name, forward_seq FROM primers")
def number_primers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.number_primers(T.primers(spark, sf_dir).select("name", "sourcename", "forward_seq")).select("name", "forward_seq")


@registered("SELECT DISTINCT o_orderpriority AS target, o_custkey AS primer_name FROM orders")
def collection_accessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.names_of(T.edge_rows(spark, sf_dir)[1], "target", "primer_name")


#: Length of every target of the written search reports.
REPORT_LENGTH = 1_000_000
_REPORT = """hits AS (SELECT 'q' || (o_orderkey % 3) AS query, regexp_replace(o_orderpriority, '[^A-Z0-9]', '', 'g') AS target, 'c' || o_custkey AS primer_name, o_orderkey,
  row_number() OVER (PARTITION BY o_orderkey % 3, o_orderpriority, o_custkey ORDER BY o_orderkey) AS idx FROM orders)"""


@registered(f"""WITH {_REPORT} SELECT query, target, primer_name, idx::INT AS idx, 'Amplimer ' || idx AS amplimer, o_orderkey::BIGINT AS fwd_start, (o_orderkey + 4)::BIGINT AS fwd_end,
(o_orderkey % 3)::INT AS fwd_mismatches, ({REPORT_LENGTH} - 7 - o_orderkey + 1)::BIGINT AS rev_end, ({REPORT_LENGTH} - 7 - o_orderkey + 1 - 5)::BIGINT AS rev_start, (60 + o_orderkey % 200)::BIGINT AS length FROM hits""")
def scan_primersearch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as amplimers of their customers, written as reports by query and target and read back."""
    o = T.read(spark, sf_dir, "orders")
    key, text = F.col("o_orderkey"), lambda c: c.cast("string")
    query, target = F.concat(F.lit("q"), text(key % 3)), F.regexp_replace("o_orderpriority", "[^A-Z0-9]", "")
    hit = F.concat(
        F.lit("\n\tSequence: s \n\t\n\tACGT hits forward strand at "), text(key), F.lit(" with "), text(key % 3), F.lit(" mismatches\n\tACGTA hits reverse strand at ["),
        text(key + 7), F.lit("] with 0 mismatches\n\tAmplimer length: "), text(60 + key % 200), F.lit(" bp\n"),
    )
    rows = o.select(F.concat_ws("_ps_", query, target).alias("report"), "o_custkey", F.struct(key, hit.alias("hit")).alias("x"))
    rows = rows.groupBy("report", "o_custkey").agg(F.array_sort(F.collect_list("x")).alias("x"))
    amplimers = F.transform("x", lambda x, i: F.concat(F.lit("Amplimer "), (i + 1).cast("string"), x["hit"]))
    rows = rows.select("report", F.concat(F.lit("\nPrimer name c"), text(F.col("o_custkey")), F.lit("\n"), F.array_join(amplimers, "")).alias("value"))
    path = T.scratch(spark, "reports")
    rows.write.partitionBy("report").text(path)
    lengths = o.select(target.alias("target")).distinct().withColumn("target_length", F.lit(REPORT_LENGTH))
    found = R.scan_primersearch_report(spark, path, lengths)
    whole = lambda *cs: [F.col(c).cast("long").alias(c) for c in cs]
    return found.select("query", "target", "primer_name", "idx", "amplimer", *whole("fwd_start", "fwd_end"), "fwd_mismatches", *whole("rev_end", "rev_start", "length"))


_TARGETS = "SELECT o_orderpriority AS target, 'c' || o_custkey AS primer_name, o_orderkey::BIGINT AS fwd_start, (o_orderkey + 100)::BIGINT AS rev_end FROM orders"


@registered(_TARGETS)
def split_on_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amplimers written by target, as JSON and BED, and read back with the targets that the folders name."""
    o = T.read(spark, sf_dir, "orders")
    place = lambda at: F.struct(F.lit("AC").alias("seq"), at.alias("start"), (at + 2).alias("end"))
    name = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    amps = o.select(F.col("o_orderpriority").alias("target"), name.alias("primer_name"), F.lit("s").alias("target_fasta_id"), place(F.col("o_orderkey")).alias("fwd"), place(F.col("o_orderkey") + 98).alias("rev"))
    path = T.scratch(spark, "targets")
    W.write_target_amplicons(C.split_on_targets(amps), path)
    json = spark.read.json(f"{path}/json").select(F.col("part").alias("target"), "primer_name", F.col("fwd.start").alias("fwd_start"), F.col("rev.end").alias("rev_end"))
    bed = spark.read.schema("id string, fwd_start long, rev_end long, primer_name string, part string").csv(f"{path}/bed", sep="\t")
    bed = bed.select(F.col("part").alias("target"), "primer_name", "fwd_start", "rev_end")
    return json.intersectAll(bed)


@registered(f"""
WITH {T.EDGES}, {T.LABELS_SQL}, g AS (SELECT "group", list_sort(list(DISTINCT m)) AS members FROM (SELECT "group", unnest(members) AS m FROM labels_t) GROUP BY 1),
f AS (SELECT "group", primer FROM g LEFT JOIN hits ON hits.targets = g.members), n AS (SELECT "group", count(primer)::INT AS "NumPrimers" FROM f GROUP BY 1)
SELECT "group" AS "Group", "NumPrimers", coalesce(primer::VARCHAR, '') AS name, coalesce(sourcename, '') AS sourcename FROM f JOIN n USING ("group") LEFT JOIN own ON own.name = f.primer""")
def write_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary and primers by label, written and read back; labels without primers have a row without one."""
    own, _ = T.edge_rows(spark, sf_dir)
    path = T.scratch(spark, "classification")
    W.write_classification(C.process_groups(T.labels(spark)), classify_exact_set(spark, sf_dir), own, path)
    summary = spark.read.schema("Group string, NumPrimers int, Primers string").csv(f"{path}/summary", sep="\t", header=True)
    found = spark.read.schema("name long, sourcename string, group string").json(f"{path}/primers")
    rows = summary.join(found.withColumnRenamed("group", "label"), F.col("Group") == F.col("label"), "left")
    return rows.select("Group", "NumPrimers", F.coalesce(F.col("name").cast("string"), F.lit("")).alias("name"), F.coalesce("sourcename", F.lit("")).alias("sourcename"))


@registered(f"WITH {T.MANIFEST} SELECT name, seqfile FROM man WHERE name = 'Supplier#000000005'")
def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.lookup(T.manifest(spark, sf_dir), "Supplier#000000005").select("name", "seqfile")


@registered(f"""WITH {T.INTERVALS} SELECT chrom, "start", "end" FROM iv ORDER BY 1, 2, 3""")
def interval_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.interval_sort(T.intervals(spark, sf_dir).select("chrom", "start", "end"))
