"""Interval algebra on half-open intervals (chrom, start, end), as scans along sorted ends (see ``scans``).

No task holds a chromosome: partitions are runs of the sorted rows, and one carried row leads from each to the next. ``parts`` asks for a number of
partitions; without it Spark chooses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scans


def interval_merge(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Union of overlapping and book-ended intervals."""
    return scans.merge(rows, ["chrom"], parts)


def interval_complement(rows: DataFrame, lengths: DataFrame, parts: int | None = None) -> DataFrame:
    """Gaps between the intervals of each chromosome of ``lengths`` (chrom, length), the ends included."""
    whole = lengths.select("chrom", F.lit(0).cast("long").alias("start"), F.col("length").cast("long").alias("end"), F.lit(0).alias("part"))
    merged = interval_merge(rows, parts).withColumn("part", F.lit(1))
    return _depth(whole.union(merged), parts).where("first > 0 and depth = first").select("chrom", "start", "end")


def _depth(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Segments between neighbouring ends with ``depth``: how many sets (column ``part``) cover them, and ``first``: whether set 0 does. Each part must be merged."""
    rows = rows.where("start < end")
    first = F.when(F.col("part") == 0, 1).otherwise(0)
    ends = rows.select("chrom", F.col("start").alias("at"), F.lit(1).alias("d"), first.alias("d0")).union(rows.select("chrom", "end", F.lit(-1), -first))
    return scans.depth(ends, ["chrom"], parts)


def _merged_sets(sets: list[DataFrame], parts: int | None = None) -> DataFrame:
    """All sets, each merged by itself, with its number as ``part``: one scan."""
    out = None
    for i, s in enumerate(sets):
        rows = s.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.lit(i).alias("part"))
        out = rows if out is None else out.union(rows)
    return scans.merge(out, ["chrom", "part"], parts)


def interval_intersect_any(first: DataFrame, others: list[DataFrame], parts: int | None = None) -> DataFrame:
    """Where ``first`` and at least one of ``others`` lie, merged."""
    return interval_merge(_depth(_merged_sets([first, *others], parts), parts).where("first > 0 and depth > first"), parts)


def interval_intersect_all(sets: list[DataFrame], parts: int | None = None) -> DataFrame:
    """Where all sets lie, merged. An empty set makes the result empty."""
    return interval_merge(_depth(_merged_sets(sets, parts), parts).where(F.col("depth") == len(sets)), parts)


def interval_coverage(rows: DataFrame) -> DataFrame:
    """chrom, regions, covered: number and total length of the intervals of each chromosome."""
    return rows.groupBy("chrom").agg(F.count("*").alias("regions"), F.sum(F.col("end") - F.col("start")).alias("covered"))


def interval_sort(rows: DataFrame) -> DataFrame:
    return rows.orderBy("chrom", "start", "end")


def feature_flank(rows: DataFrame, lengths: DataFrame, flank: int) -> DataFrame:
    """Intervals widened by ``flank`` on both sides, within the chromosome."""
    wide = rows.join(lengths, "chrom")
    return wide.withColumn("start", F.greatest(F.lit(0), F.col("start") - flank)).withColumn("end", F.least(F.col("length"), F.col("end") + flank)).drop("length")


def alignment_quality_filter(rows: DataFrame, min_sim_errors: int = 0, min_err_rate: float = 0.0) -> DataFrame:
    """Alignments with at least so many differences and so high a rate; one of no length has no rate and goes if a rate is asked for."""
    rate = F.try_divide(F.col("sim_errors"), F.col("end") - F.col("start"))
    keep = F.col("sim_errors") >= min_sim_errors
    return rows.where(keep & (F.coalesce(rate, F.lit(-1.0)) >= min_err_rate) if min_err_rate > 0 else keep)


def common_regions(alignments: DataFrame, min_sim_errors: int = 0, min_err_rate: float = 0.0, mode: str = "any", parts: int | None = None) -> DataFrame:
    """(query, start, end): what each genome's alignments to the other members have in common.

    ``alignments`` has query, subject, start, end, sim_errors. ``any`` takes the first subject's regions where any other
    subject's lie as well, ``all`` where all do, counted by the comparisons asked for. With one comparison its merged regions come out.
    """
    if mode not in ("any", "all"):
        raise ValueError(f"mode: {mode}")
    asked = alignments.select("query", "subject").distinct()
    part = F.row_number().over(Window.partitionBy("query").orderBy("subject")) - 1
    asked = asked.withColumn("part", part).withColumn("k", F.count("*").over(Window.partitionBy("query")))
    good = alignment_quality_filter(alignments, min_sim_errors, min_err_rate).join(asked, ["query", "subject"])
    rows = scans.merge(good.select(F.col("query").alias("chrom"), "part", "start", "end"), ["chrom", "part"], parts)
    seg = _depth(rows, parts).join(asked.select(F.col("query").alias("chrom"), "k").distinct(), "chrom")
    many = (F.col("first") > 0) & (F.col("depth") > F.col("first")) if mode == "any" else F.col("depth") == F.col("k")
    return interval_merge(seg.where(F.when(F.col("k") == 1, F.col("depth") > 0).otherwise(many)), parts).withColumnRenamed("chrom", "query")
