"""Operators over tables of sequences (name, seq_id, description, ord, seq)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmark.functions.sequence import SPACER, is_ambiguous, without_ambiguities


def in_order(sep: str, ord_col: str = "ord", seq: str = "seq"):
    """Aggregate: the sequences of a group in record order, joined by ``sep``."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), F.col(seq).alias("s"))))
    return F.array_join(F.transform(rows, lambda x: x["s"]), sep)


def stitch(sequences: DataFrame, spacer: str = SPACER) -> DataFrame:
    """One record for each genome, whole (``tiles.stitch`` has it in tiles, for genomes beyond 2 GB). Several records are joined in order with spacers under a new id; a single one stays as it is."""
    many = F.col("n") > 1
    rows = sequences.groupBy("name").agg(
        F.count("*").alias("n"), in_order(spacer).alias("joined"), F.min("seq_id").alias("id"), F.min("description").alias("about")
    )
    return rows.select(
        "name",
        F.when(many, F.concat("name", F.lit("_concatenated"))).otherwise(F.col("id")).alias("seq_id"),
        F.when(many, F.concat("name", F.lit(", concatenated with spacers"))).otherwise(F.col("about")).alias("description"),
        F.lit(0).alias("ord"),
        F.col("joined").alias("seq"),
        many.alias("stitched"),
    )


def replace_ambiguities(sequences: DataFrame) -> DataFrame:
    """In genomes with any ambiguity code, write N for each and mark every record's id."""
    names = sequences.where(is_ambiguous(F.col("seq"))).select(F.col("name").alias("__name"), F.lit(True).alias("__any")).distinct()
    rows = sequences.join(sized(names), F.col("name").eqNullSafe(F.col("__name")), "left")
    rows = rows.withColumn("replaced", F.coalesce("__any", F.lit(False))).drop("__name", "__any")
    return rows.withColumn("seq", F.when(F.col("replaced"), without_ambiguities(F.col("seq"))).otherwise(F.col("seq"))).withColumn(
        "seq_id", F.when(F.col("replaced"), F.concat("seq_id", F.lit("_noambig"))).otherwise(F.col("seq_id"))
    )


def fix_sequences(sequences: DataFrame) -> DataFrame:
    """Stitch, then replace ambiguity codes."""
    return replace_ambiguities(stitch(sequences))


def genome_lengths(sequences: DataFrame) -> DataFrame:
    return sequences.select("seq_id", F.length("seq").alias("length"))


def filtered_sequence(sequences: DataFrame, regions: DataFrame, flank: int = 0, spacer_length: int = 150, suffix: str = "filtered") -> DataFrame:
    """Regions of each genome, in the order ``ord`` of the feature file, joined by runs of N, as whole records (``tiles.filtered`` has them in tiles). Genomes
    without regions have no row."""
    from . import tiles

    cut = tiles.tiled(sequences)
    whole = tiles.assembled(tiles.filtered(cut, regions, flank, spacer_length, suffix), ["name", "seq_id"])
    n = regions.join(sequences.select("seq_id", F.col("name").alias("__name")), "seq_id").groupBy("__name").agg(F.count("*").alias("n_regions"))
    return whole.join(n, F.col("name").eqNullSafe(F.col("__name"))).select("seq_id", "name", "n_regions", "seq")


def sized(rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``rows``, narrow ones, to be sent to all tasks if they are at most ``most``: counts no further than that."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows.hint("merge")


def pieces(sequences: DataFrame, before: int, after: int, size: int, large: int) -> DataFrame:
    """Records as short pieces with ``offset`` of the bases that are a piece's own, ``own``, how many, ``lead``, how many of the neighbour's stand before
    them in ``seq`` (up to ``before``; up to ``after`` follow).

    Cut in two steps: finding a place in a text means walking to it, so short pieces are cut from large ones.
    """

    def cut(rows: DataFrame, n: int) -> DataFrame:
        rows = rows.withColumn("__at", F.explode(F.sequence(F.lit(0), F.greatest(F.col("own") - 1, F.lit(0)), F.lit(n))))
        rows = rows.withColumn("__lead", F.least(F.col("lead") + F.col("__at"), F.lit(before)))
        rows = rows.withColumn("__own", F.least(F.lit(n), F.col("own") - F.col("__at")))
        text = F.substring(F.col("seq"), F.col("lead") + F.col("__at") - F.col("__lead") + 1, F.col("__lead") + F.col("__own") + after)
        rows = rows.withColumn("seq", text).withColumn("offset", F.col("offset") + F.col("__at"))
        return rows.withColumn("own", F.col("__own")).withColumn("lead", F.col("__lead")).drop("__at", "__lead", "__own")

    rows = sequences.withColumns({"offset": F.lit(0), "own": F.length("seq"), "lead": F.lit(0)})
    return cut(cut(rows, large), size)
