"""Amplified regions and how much they differ."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortmark.functions.sequence import reverse_complement

from . import align, tiles
from .classify import MAX_AMPLICON, MIN_AMPLICON
from .storage import ship, stored


def extract_amplicons(amplimers: DataFrame, primers: DataFrame, sequences: DataFrame, low: int = MIN_AMPLICON, high: int = MAX_AMPLICON) -> DataFrame:
    """primer, target, idx, amplicon_name, seq: the region of each numbered amplimer, read in its primer's direction.

    ``amplimers`` has primer_name, target, idx, fwd_seq, fwd_start (from 1), rev_end; ``sequences`` has name, seq, whole or in tiles (name, tile, seq). Only
    lengths strictly between the bounds stay; numbering is that of ``amplimers``.
    """
    cut = sequences if "tile" in sequences.columns else tiles.tiled(sequences.select("name", "seq"))
    rows = amplimers.join(primers.select(F.col("name").alias("primer_name"), "forward_seq"), "primer_name")
    first, last = F.least("fwd_start", "rev_end"), F.greatest("fwd_start", "rev_end")
    rows = rows.select("target", "primer_name", "idx", (F.col("forward_seq") == F.col("fwd_seq")).alias("plus"), (first - 1).alias("start"), last.alias("end"))
    rows = tiles.regions(cut.withColumnRenamed("name", "target"), rows, "target")
    rows = rows.where((F.length("seq") > low) & (F.length("seq") < high)).withColumn("seq", F.when(F.col("plus"), F.col("seq")).otherwise(reverse_complement(F.col("seq"))))
    name = F.concat_ws("_", "primer_name", "target", F.col("idx").cast("string"))
    return rows.select(F.col("primer_name").alias("primer"), "target", "idx", name.alias("amplicon_name"), "seq")


def _with_dist(batch: pa.RecordBatch, dist: np.ndarray) -> pa.RecordBatch:
    keep = [i for i, name in enumerate(batch.schema.names) if name not in ("x", "y")]
    return pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(dist, from_pandas=True)], names=[*[batch.schema.names[i] for i in keep], "dist"])


def _aligned(batches):
    for batch in batches:
        yield _with_dist(batch, align.aligned_distances(batch.column("x").to_pylist(), batch.column("y").to_pylist()))


def _edited(batches):
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        both = pa.compute.and_(x.is_valid(), y.is_valid())
        rows = np.flatnonzero(both.to_numpy(zero_copy_only=False))
        xs, ys = x.filter(both).to_pylist(), y.filter(both).to_pylist()
        dist = np.full(len(x), np.nan)
        dist[rows] = align.edit_distances(xs, ys) / np.maximum([max(len(a), len(b)) for a, b in zip(xs, ys, strict=True)], 1)
        yield _with_dist(batch, dist)


def measured(pairs: DataFrame, aligned: bool) -> DataFrame:
    """``pairs`` with ``dist`` of their columns x and y in place of these: the part of places that differ, or the Levenshtein distance as a part of the longer length."""
    ship(pairs.sparkSession)
    return pairs.mapInArrow(_aligned if aligned else _edited, StructType([*[f for f in pairs.schema if f.name not in ("x", "y")], StructField("dist", DoubleType())]))


def pair_distances(amplicons: DataFrame, aligned: bool = True) -> DataFrame:
    """primer, a, b, dist for each unordered pair of a primer's amplicons."""
    a = amplicons.select("primer", F.col("amplicon_name").alias("a"), F.col("seq").alias("x"))
    b = amplicons.select(F.col("primer").alias("p"), F.col("amplicon_name").alias("b"), F.col("seq").alias("y"))
    return measured(a.join(b, (F.col("primer") == F.col("p")) & (F.col("a") < F.col("b"))).select("primer", "a", "b", "x", "y"), aligned)


def shannon_index(amplicons: DataFrame) -> DataFrame:
    """primer, n_unique, n_nonunique, shannon, evenness of the distinct sequences."""
    counts = amplicons.groupBy("primer", "seq").agg(F.count("*").alias("c"))
    # -sum(p ln p) = ln n - sum(c ln c) / n, in one aggregation
    sums = counts.groupBy("primer").agg(F.sum("c").alias("n"), F.count("*").alias("s"), F.sum(F.col("c") * F.log("c")).alias("cl"))
    h = F.when(F.col("s") > 1, F.log("n") - F.col("cl") / F.col("n")).otherwise(0.0)
    return sums.select("primer", F.col("s").alias("n_unique"), (F.col("n") - F.col("s")).alias("n_nonunique"), h.alias("shannon"), F.when(F.col("s") > 1, h / F.log("s")).otherwise(0.0).alias("evenness"))


def unique_counts(amplicons: DataFrame) -> DataFrame:
    return amplicons.groupBy("primer").agg(F.count_distinct("seq").alias("n_unique"), (F.count("*") - F.count_distinct("seq")).alias("n_nonunique"))


def pairwise_distance_stats(amplicons: DataFrame, aligned: bool = True) -> DataFrame:
    """One row for each primer: mean, sample deviation, least and greatest distance; zeros with fewer than two amplicons.

    Equal sequences collapse first: pairs are of different sequences, each counted as often as it stands, and equal ones add distance 0.
    """
    each = amplicons.groupBy("primer", "seq").agg(F.count("*").alias("c"))
    a, b = each.select("primer", F.col("seq").alias("x"), F.col("c").alias("cx")), each.select(F.col("primer").alias("p"), F.col("seq").alias("y"), F.col("c").alias("cy"))
    pairs = a.join(b, (F.col("primer") == F.col("p")) & (F.col("x") < F.col("y"))).select("primer", "x", "y", (F.col("cx") * F.col("cy")).alias("w"))
    pairs = measured(pairs, aligned).select("primer", F.col("dist").alias("d"), "w")
    same = each.where("c > 1").select("primer", F.lit(0.0).alias("d"), (F.col("c") * (F.col("c") - 1) / 2).cast("long").alias("w"))
    w, d = F.col("w"), F.col("d")
    stats = pairs.union(same).groupBy("primer").agg(F.sum("w").alias("n"), (F.sum(w * d) / F.sum("w")).alias("dist_mean"), F.sum(w * d * d).alias("dd"), F.min("d").alias("dist_min"), F.max("d").alias("dist_max"))
    spread = F.greatest(F.col("dd") - F.col("n") * F.col("dist_mean") * F.col("dist_mean"), F.lit(0.0))
    stats = stats.withColumn("dist_sd", F.when(F.col("n") > 1, F.sqrt(spread / (F.col("n") - 1))))
    out = shannon_index(amplicons).join(stats, "primer", "left")
    return out.fillna(0.0, ["dist_mean", "dist_sd", "dist_min", "dist_max"]).select("primer", "dist_mean", "dist_sd", "dist_min", "dist_max", "n_unique", "n_nonunique", "shannon", "evenness")


def single_sequence_passthrough(amplicons: DataFrame) -> DataFrame:
    """Amplicons of primers that have only one: their alignment is the sequence itself."""
    alone = amplicons.groupBy("primer").agg(F.count("*").alias("n")).where("n < 2").select("primer")
    return amplicons.join(alone, "primer", "left_semi")


def marker_scatter(stats: DataFrame) -> DataFrame:
    """Points and axis ranges of the plot of distance against non-unique amplicons."""
    stats = stored(stats.select("primer", "n_unique", "n_nonunique", "dist_mean"), "stats")  # read twice
    ends = stats.agg((F.max("n_unique") * 1.2).alias("x_max"), (F.max("dist_mean") * 1.2).alias("y_max"))
    points = stats.select(F.col("n_nonunique").alias("x"), F.col("dist_mean").alias("y"), F.col("primer").alias("label"))
    return points.crossJoin(F.broadcast(ends)).withColumn("x_min", F.lit(-0.1)).withColumn("y_min", F.lit(-0.01))  # one row


def marker_pareto(stats: DataFrame) -> DataFrame:
    """Primers that no other beats: none has as few non-unique amplicons and a larger mean distance, or fewer and as large.

    Best distances for each count of non-unique amplicons come first, so the running maximum spans counts, not primers.
    """
    from pyspark.sql import Window

    best = stats.groupBy("n_nonunique").agg(F.max("dist_mean").alias("dist_mean"))
    fewer = Window.orderBy("n_nonunique").rowsBetween(Window.unboundedPreceding, -1)
    best = best.withColumn("before", F.max("dist_mean").over(fewer)).where("before is null or dist_mean > before").drop("before")
    return stats.join(best, ["n_nonunique", "dist_mean"], "left_semi")
