"""Deduplication, screening and exact classification of primer pairs.

A primer is diagnostic for a label if the set of genomes that it amplifies is the set of the label's members.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_AMPLICON, MAX_AMPLICON, MAX_ALIGNMENT = 50, 300, 15


def amplimer_length_filter(rows: DataFrame, low: int = MIN_AMPLICON, high: int = MAX_AMPLICON, column: str = "length") -> DataFrame:
    """Strictly between the bounds."""
    return rows.where((F.col(column) > low) & (F.col(column) < high))


def process_groups(manifest: DataFrame) -> DataFrame:
    """group, members: the sorted names of each label's genomes."""
    rows = manifest.select(F.explode("groups").alias("group"), "name")
    return rows.groupBy("group").agg(F.sort_array(F.collect_set("name")).alias("members"))


def edges(primers: DataFrame, amplimers: DataFrame, low: int = MIN_AMPLICON, high: int = MAX_AMPLICON) -> DataFrame:
    """(primer, target): each primer's own genome, always, and every genome it amplifies at an accepted length."""
    own = primers.select(F.col("name").alias("primer"), F.col("sourcename").alias("target"))
    hits = amplimer_length_filter(amplimers, low, high).select(F.col("primer_name").alias("primer"), "target")
    return own.union(hits).distinct()


def process_crosshyb(primers: DataFrame, amplimers: DataFrame, low: int = MIN_AMPLICON, high: int = MAX_AMPLICON) -> DataFrame:
    """primer, targets: the sorted set of genomes that each primer hits."""
    return edges(primers, amplimers, low, high).groupBy("primer").agg(F.sort_array(F.collect_set("target")).alias("targets"))


def exact_set_match(hits: DataFrame, groups: DataFrame) -> DataFrame:
    """(group, primer) with equal sets; labels with the same members match the same primers."""
    return hits.join(groups, hits["targets"] == groups["members"]).select("group", "primer")


def classify_primers(manifest: DataFrame, primers: DataFrame, amplimers: DataFrame, low: int = MIN_AMPLICON, high: int = MAX_AMPLICON) -> DataFrame:
    """(group, primer) of every diagnostic primer, of hits on primers that exist."""
    own = amplimers.join(primers.select(F.col("name").alias("primer_name")), "primer_name", "left_semi")
    return exact_set_match(process_crosshyb(primers, own, low, high), process_groups(manifest))


def diagnostic_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("group").agg(F.count("primer").alias("n_primers"))


def group_summary_outer(groups: DataFrame, found: DataFrame) -> DataFrame:
    """group, n_primers for every label, those without primers too."""
    return groups.select("group").distinct().join(found, "group", "left").groupBy("group").agg(F.count("primer").alias("n_primers"))


def _first_pairs(primers: DataFrame) -> DataFrame:
    """One row ``x``, all columns in one, for each (forward, reverse): partial minima, so a pair that a third of all rows hold is a row for each task."""
    rest = [c for c in primers.columns if c not in ("sourcename", "name")]
    return primers.groupBy("forward_seq", "reverse_seq").agg(F.min(F.struct("sourcename", "name", *rest)).alias("x")).select("x")


def dedupe_primers(primers: DataFrame) -> DataFrame:
    """The first pair of each (forward, reverse), by genome and then name; a swapped pair is another pair."""
    return _first_pairs(primers).select("x.*").select(primers.columns)


def dedupe_counts(primers: DataFrame) -> DataFrame:
    """sourcename, kept, removed."""
    primers = primers.select("sourcename", "name", "forward_seq", "reverse_seq")
    kept = _first_pairs(primers).groupBy(F.col("x.sourcename").alias("s")).agg(F.count("*").alias("kept"))
    every = primers.groupBy("sourcename").agg(F.count("*").alias("n")).join(kept, F.col("sourcename").eqNullSafe(F.col("s")), "left")
    return every.select("sourcename", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("n") - F.coalesce("kept", F.lit(0))).alias("removed"))


def hit_primers(hits: DataFrame, max_alignment: int = MAX_ALIGNMENT) -> DataFrame:
    """Names of pairs with an alignment longer than allowed; a query is the pair's name and four characters for the oligo."""
    return hits.where(F.col("length") > max_alignment).select(F.expr("substring(query, 1, length(query) - 4)").alias("name")).distinct()


def primer_screen_anti(primers: DataFrame, hits: DataFrame, max_alignment: int = MAX_ALIGNMENT) -> DataFrame:
    return primers.join(hit_primers(hits, max_alignment), "name", "left_anti")


def amplimers_semi(amplimers: DataFrame, primers: DataFrame) -> DataFrame:
    """Amplimers of the given primers (column ``primer``)."""
    return amplimers.join(primers.select(F.col("primer").alias("primer_name")).distinct(), "primer_name", "left_semi")


def primers_to_source(primers: DataFrame, genomes: DataFrame, source: str = "source") -> DataFrame:
    """Pairs with the columns of the genome (or record) that they were designed on."""
    return primers.join(genomes, source).drop(source)


def split_on_targets(amplimers: DataFrame, target: str | None = None) -> DataFrame:
    """Amplimers with their targets as ``part``, by which a writer splits them; or those of one target."""
    rows = amplimers.withColumn("part", F.col("target"))
    return rows if target is None else rows.where(F.col("target") == target)


def names_of(rows: DataFrame, *columns: str) -> DataFrame:
    """What a collection holds, sorted: its labels, primers, targets or any other columns, each once."""
    return rows.select(*columns).distinct().orderBy(*columns)


def index_by_primer(amplicons: DataFrame) -> DataFrame:
    """primer, rank (from 1, by name), amplicon_name: the amplicons of each primer, as rows."""
    order = Window.partitionBy("primer").orderBy("amplicon_name")
    return amplicons.select("primer", F.row_number().over(order).alias("rank"), "amplicon_name")


def number_primers(primers: DataFrame, stem: str = "sourcename", order: str = "name") -> DataFrame:
    """Names <stem>_primer_<ordinal from 1 of each stem, five digits>, in the given order."""
    n = F.row_number().over(Window.partitionBy(stem).orderBy(order))
    return primers.withColumn("name", F.format_string("%s_primer_%05d", F.col(stem), n))


def collect_amplimers(reports: DataFrame) -> DataFrame:
    """All reports' amplimers by the genome they lie in: target, n_primers, n_amplimers."""
    return reports.groupBy("target").agg(F.count_distinct("primer_name").alias("n_primers"), F.count("*").alias("n_amplimers"))


def number_amplimers(amplimers: DataFrame, order: list[str]) -> DataFrame:
    """Ordinal of each amplimer of a primer in a target, from 1, before any filter."""
    return amplimers.withColumn("idx", F.row_number().over(Window.partitionBy("primer_name", "target").orderBy(*order)))
