"""Writers. Each builds a DataFrame of lines (``value``) and leaves the files to Spark; ordered outputs are one sorted write."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from cohortmark.operators.manifest import FIELDS, check_manifest_format

from .readers import scan_manifest_json, scan_manifest_tab


def by_file(rows: DataFrame, *partition: str) -> DataFrame:
    """``rows`` dealt by the files that they go to. Files cost time by their number, which Spark does not see in the bytes: left to itself it lets one task write them all."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *partition)


def filed(rows: DataFrame, *partition: str) -> DataFrameWriter:
    """A writer of a file or more for each value of ``partition``. Tasks move their files into place themselves, the driver does not move one after another; a write that
    failed leaves files but no _SUCCESS."""
    return rows.write.partitionBy(*partition).option("mapreduce.fileoutputcommitter.algorithm.version", "2")


def _text(rows: DataFrame, path: str, order: list[str], partition: list[str] = ()) -> None:
    """Lines in order. Partitioned outputs are dealt by partition and sorted within; others are range-sorted as a whole."""
    if partition:
        filed(by_file(rows, *partition).sortWithinPartitions(*partition, *order).select(*partition, "value"), *partition).mode("overwrite").text(path)
    else:
        rows.orderBy(*order).select("value").write.mode("overwrite").text(path)


def manifest_json(manifest: DataFrame) -> DataFrame:
    """One array of all genomes by name, keys sorted. A manifest is a work list, so it fits one row."""
    rows = manifest.agg(F.array_sort(F.collect_list(F.struct("name", F.struct(*sorted(FIELDS)).alias("entry")))).alias("x"))
    return rows.select(F.to_json(F.transform("x", lambda e: e["entry"]), {"ignoreNullFields": "false"}).alias("value"))


def write_manifest_json(manifest: DataFrame, path: str) -> None:
    manifest_json(manifest).write.mode("overwrite").text(path)


def manifest_tab(manifest: DataFrame) -> DataFrame:
    return manifest.select("name", F.concat_ws("\t", "name", F.array_join("groups", ","), F.coalesce("seqfile", F.lit("-")), F.coalesce("features", F.lit("-"))).alias("value"))


def write_manifest_tab(manifest: DataFrame, path: str) -> None:
    _text(manifest_tab(manifest), path, ["name"])


def convert_manifest(spark: SparkSession, source: str, path: str) -> str:
    """TSV to JSON or JSON to TSV, by the extension of ``source``; what was written."""
    if check_manifest_format(source) == "tab":
        write_manifest_json(scan_manifest_tab(spark, source), path)
        return "json"
    write_manifest_tab(scan_manifest_json(spark, source), path)
    return "tab"


def primers_tsv(primers: DataFrame) -> DataFrame:
    spark = primers.sparkSession
    head = spark.createDataFrame([(0, "", "# PRIMERS"), (1, "", "# Name       FWD        REV")], "k int, name string, value string")
    return head.union(primers.select(F.lit(2).alias("k"), "name", F.concat_ws("\t", "name", "forward_seq", "reverse_seq").alias("value")))


def primers_fasta(primers: DataFrame) -> DataFrame:
    one = lambda arm, tag: F.struct(F.lit(tag).alias("tag"), F.col(f"{arm}_seq").alias("seq"))
    rows = primers.select("name", F.explode(F.array(one("forward", "fwd"), one("reverse", "rev"), one("internal", "int"))).alias("x"))
    rows = rows.where("x.tag <> 'int' or coalesce(x.seq, '') <> ''")
    return rows.select("name", F.col("x.tag").alias("k"), F.concat(F.lit(">"), "name", F.lit("_"), "x.tag", F.lit("\n"), "x.seq").alias("value"))


def primers_bed(primers: DataFrame) -> DataFrame:
    """chrom, forward start as it is, reverse start less one, name. ``chrom`` is the column source_id."""
    return primers.select("name", F.concat_ws("\t", "source_id", F.col("forward_start").cast("string"), (F.col("reverse_start") - 1).cast("string"), "name").alias("value"))


def primers_eprimer3(primers: DataFrame, by: str = "sourcename") -> DataFrame:
    """Report blocks, numbered from 1 within each genome."""
    n = F.row_number().over(Window.partitionBy(by).orderBy("name"))
    arm = lambda label, a: F.format_string(f"     {label}  %-10d %2d  %.02f  %.02f  %s", f"{a}_start", f"{a}_length", f"{a}_tm", f"{a}_gc", f"{a}_seq")
    block = F.concat_ws("\n", F.concat(F.lit("# "), "name"), F.format_string("%-4d PRODUCT SIZE: %d", n, "size"), arm("FORWARD PRIMER", "forward"), arm("REVERSE PRIMER", "reverse"), arm("INTERNAL OLIGO", "internal"), F.lit("\n"))
    return primers.select(by, "name", block.alias("value"))


def write_primers(primers: DataFrame, path: str, fmt: str = "json", by: str = "sourcename") -> None:
    """Sorted by name, reports in a folder for each ``by``, in one of the formats json, eprimer3, tsv, bed, and FASTA for any other name."""
    if fmt == "json":
        write_primers_json(primers, path)
    elif fmt in ("ep3", "eprimer3"):
        _text(primers_eprimer3(primers, by), path, ["name"], [by])
    elif fmt in ("tsv", "tab"):
        _text(primers_tsv(primers), path, ["k", "name"])
    elif fmt == "bed":
        _text(primers_bed(primers), path, ["name"])
    else:
        _text(primers_fasta(primers), path, ["name", "k"])


def write_primers_json(primers: DataFrame, path: str) -> None:
    primers.withColumn("genome", F.col("sourcename")).repartition("genome").sortWithinPartitions("genome", "name").write.partitionBy("genome").mode("overwrite").json(path)


def amplicons_bed(amplimers: DataFrame) -> DataFrame:
    return amplimers.select("target", "primer_name", F.concat_ws("\t", "target_fasta_id", F.col("fwd.start").cast("string"), F.col("rev.end").cast("string"), "primer_name").alias("value"))


def write_target_amplicons(amplimers: DataFrame, path: str) -> None:
    """JSON and BED by target, below ``path``/json and ``path``/bed; the folders name the target as ``part``."""
    from cohortmark.operators.classify import split_on_targets

    rows = split_on_targets(amplimers)
    rows.repartition("part").sortWithinPartitions("part", "primer_name").write.partitionBy("part").mode("overwrite").json(f"{path}/json")
    _text(amplicons_bed(amplimers).withColumnRenamed("target", "part"), f"{path}/bed", ["primer_name"], ["part"])


def classification_summary(groups: DataFrame, found: DataFrame, prefix: str) -> DataFrame:
    from cohortmark.operators.classify import group_summary_outer

    rows = group_summary_outer(groups, found)
    return rows.select(F.col("group").alias("Group"), F.col("n_primers").alias("NumPrimers"), F.concat(F.lit(prefix + "/"), "group", F.lit("_primers.json")).alias("Primers"))


def write_classification(groups: DataFrame, found: DataFrame, primers: DataFrame, path: str) -> None:
    """Primers of each label as JSON by label, from whole primer tables also as reports by label, and a summary with every label."""
    rows = found.join(primers.withColumnRenamed("name", "primer"), "primer").withColumnRenamed("primer", "name")
    rows.repartition("group").sortWithinPartitions("group", "name").write.partitionBy("group").mode("overwrite").json(f"{path}/primers")
    if set(f"{arm}_seq" for arm in ("forward", "reverse", "internal")) <= set(rows.columns):  # whole primer tables: a report for each label as well
        write_primers(rows, f"{path}/reports", "eprimer3", "group")
    classification_summary(groups, found, path).orderBy("Group").write.mode("overwrite").csv(f"{path}/summary", sep="\t", header=True)


def amplicon_fasta(amplicons: DataFrame) -> DataFrame:
    return amplicons.select("primer", "amplicon_name", F.concat(F.lit(">"), "amplicon_name", F.lit(" Predicted diagnostic amplicon\n"), "seq").alias("value"))


def write_amplicon_fasta(amplicons: DataFrame, path: str) -> None:
    _text(amplicon_fasta(amplicons), path, ["amplicon_name"], ["primer"])


def distance_summary(stats: DataFrame) -> DataFrame:
    four = lambda c: F.format_string("%.4f", c).alias(c)
    return stats.select("primer", *map(four, ("dist_mean", "dist_sd", "dist_min", "dist_max")), F.col("n_unique").alias("unique"), F.col("n_nonunique").alias("nonunique"), F.format_string("%.2f", "shannon").alias("shannon_index"), F.format_string("%.2f", "evenness").alias("shannon_evenness"))


def write_distance_summary(stats: DataFrame, path: str) -> None:
    distance_summary(stats).orderBy("primer").write.mode("overwrite").csv(path, sep="\t", header=True)


def write_bedgenome(sequences: DataFrame, path: str) -> None:
    sequences.select("seq_id", F.length("seq").alias("length")).orderBy("seq_id").write.mode("overwrite").csv(path, sep="\t")


def delta_text(rows: DataFrame) -> DataFrame:
    """Lines of alignment files from full rows: header once for each pair of records, numbers, indels and the closing 0."""
    first = F.row_number().over(Window.partitionBy("file", "header_no").orderBy("row_no")) == 1
    head = F.concat(F.lit(">"), F.concat_ws(" ", "ref", "qry", F.col("ref_length").cast("string"), F.col("qry_length").cast("string")), F.lit("\n"))
    numbers = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("ref_start", "ref_end", "qry_start", "qry_end", "errors", "sim_errors", "stops")])
    tail = F.array_join(F.concat(F.transform("indels", lambda x: x.cast("string")), F.array(F.lit("0"))), "\n")
    return rows.select("file", "row_no", F.concat(F.when(first, head).otherwise(""), numbers, F.lit("\n"), tail).alias("value"))


def boulder_lines(requests: DataFrame) -> DataFrame:
    """Lines of design requests (name, value)."""
    return requests.select("name", F.posexplode(F.split("value", "\n")).alias("k", "value"))


def write_boulder_input(requests: DataFrame, path: str) -> None:
    _text(boulder_lines(requests), path, ["k"], ["name"])


def write_delta(rows: DataFrame, path: str) -> None:
    """Alignment files by ``file``, each with its two head lines. Besides the columns of ``delta_text``, ``paths`` is what line one holds, the same in all rows of a file."""
    head = rows.groupBy("file").agg(F.concat(F.first("paths"), F.lit("\nNUCMER")).alias("value")).select("file", F.lit(-1).cast("long").alias("row_no"), "value")
    _text(head.union(delta_text(rows).select("file", F.col("row_no").cast("long"), "value")), path, ["row_no"], ["file"])
