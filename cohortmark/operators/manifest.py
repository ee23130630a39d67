"""Manifests: one row for each genome with its labels and files.

Columns: name, groups (sorted array), seqfile, filtered_seqfile, features, primers, primersearch, target_amplicons, filestem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmark.functions.sequence import filestem, is_ambiguous

FIELDS = ("name", "groups", "seqfile", "filtered_seqfile", "features", "primers", "primersearch", "target_amplicons", "filestem")
#: What the finished output of each step ends in.
SUFFIX = {"eprimer3": ".eprimer3", "primer3": ".primer3", "prodigal": ".gff", "filter": ".filter", "blastscreen": ".blasttab", "primersearch": ".primersearch", "extract": ".aln"}


def manifest_last_wins(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Of rows with one name the last stays; the result has no order column."""
    rest = [c for c in rows.columns if c not in ("name", order)]
    last = rows.groupBy("name").agg(F.max_by(F.struct(*rest), F.col(order)).alias("x"))
    return last.select(*[F.col("name") if c == "name" else F.col(f"x.`{c}`") for c in rows.columns if c != order])


def with_filestem(rows: DataFrame) -> DataFrame:
    return rows.withColumn("filestem", filestem(F.col("seqfile")))


def distinct_groups(manifest: DataFrame) -> DataFrame:
    """All labels, sorted."""
    return manifest.select(F.explode("groups").alias("group")).distinct().orderBy("group")


def group_members(manifest: DataFrame, group: str, must_exist: bool = True) -> DataFrame:
    """Genomes with a label. An unknown label raises when the result is computed, unless ``must_exist`` is off."""
    if must_exist and manifest.where(F.array_contains("groups", group)).isEmpty():
        raise ValueError(f"no genome has the label {group}")
    return manifest.where(F.array_contains("groups", group))


def lookup(manifest: DataFrame, name: str) -> DataFrame:
    return manifest.where(F.col("name") == name)


def count(manifest: DataFrame) -> DataFrame:
    """One row: how many genomes and how many different labels."""
    labels = manifest.select(F.explode("groups").alias("g")).agg(F.count_distinct("g").alias("labels"))
    return manifest.agg(F.count("*").alias("genomes")).crossJoin(labels)  # one row each


def groups_union(old: Column, new: Column) -> Column:
    """Labels after an assignment: old and new ones, sorted. ``new`` is an array."""
    return F.array_sort(F.array_distinct(F.array_union(F.coalesce(old, F.array().cast("array<string>")), new)))


def labels_of(text: Column) -> Column:
    """Labels of a comma-separated string, not trimmed."""
    return F.split(text, ",")


def validate_manifest(sequences: DataFrame) -> DataFrame:
    """name, n_records, requires_stitch, has_ambiguities from sequences (name, seq)."""
    return sequences.groupBy("name").agg(
        F.count("*").alias("n_records"), (F.count("*") > 1).alias("requires_stitch"), F.max(is_ambiguous(F.col("seq"))).alias("has_ambiguities")
    )


def has_primersearch(manifest: DataFrame) -> DataFrame:
    """One row: whether every genome has a search report."""
    return manifest.agg(F.coalesce(~F.max(F.col("primersearch").isNull()), F.lit(True)).alias("complete"))


def missing_paths(manifest: DataFrame, column: str, listing: DataFrame) -> DataFrame:
    """Rows whose file in ``column`` is not in ``listing`` (path)."""
    return manifest.where(F.col(column).isNotNull()).join(listing.select(F.col("path").alias(column)).distinct(), column, "left_anti")


def pending_work(work: DataFrame, done: DataFrame, key) -> DataFrame:
    """Work whose output does not exist yet, matched by key and not by position."""
    return work.join(done, key, "left_anti")


def output_name(step: str, stem: Column) -> Column:
    """Name of the file that a step leaves when it has finished; an unknown step raises."""
    if step not in SUFFIX:
        raise ValueError(f"unknown step {step}")
    return F.concat(stem, F.lit(SUFFIX[step]))


def pairwise_permutations(members: DataFrame, key: str = "name", within: str | None = None) -> DataFrame:
    """All ordered pairs (a, b) of different members, of the whole list or within a group. The list is a work list, not data."""
    a = members.select(F.col(key).alias("a"), *([F.col(within).alias("g")] if within else []))
    b = members.select(F.col(key).alias("b"), *([F.col(within).alias("g2")] if within else []))
    pairs = a.join(b, F.col("g") == F.col("g2")) if within else a.crossJoin(b)
    return pairs.where("a <> b").drop("g2").withColumnRenamed("g", within or "g")


def all_vs_all(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """(query, target): each genome that has primers against every genome, itself included."""
    return queries.select(F.col("name").alias("query")).distinct().crossJoin(targets.select(F.col("name").alias("target")).distinct())


def check_filter_mode(prodigal: bool = False, prodigaligr: bool = False, alnvar: str | None = None) -> str:
    """Name of the one filter mode that is set."""
    chosen = [n for n, v in (("prodigal", prodigal), ("prodigaligr", prodigaligr), ("alnvar", alnvar is not None)) if v]
    if len(chosen) != 1:
        raise ValueError("exactly one of prodigal, prodigaligr and alnvar must be chosen")
    return chosen[0]


def check_manifest_format(path: str, json_only: bool = False) -> str:
    """``json`` or ``tab`` by the file's extension."""
    kind = {"json": "json", "tab": "tab", "conf": "tab"}.get(path.rsplit(".", 1)[-1].lower() if "." in path else "")
    if kind is None or (json_only and kind != "json"):
        raise ValueError(f"{path}: manifest format not accepted here")
    return kind


def design_sequence(filtered: bool) -> Column:
    """The sequence file to design on: the filtered one if asked for and present."""
    return F.when(F.lit(filtered) & F.col("filtered_seqfile").isNotNull(), F.col("filtered_seqfile")).otherwise(F.col("seqfile"))
