"""Filtering stages: an operator's verdict on rows of their own, whatever columns and doc_ids a table has.

Rows are told apart by a key: the doc_id, or an id beyond all doc_ids for a row without one or with one that an earlier row has. So where the smallest doc_id decides,
the first row of a doc_id comes in its place, its other rows and rows without doc_id after all others. The key's name is one that no column has, and operators only
see the columns that they read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import BROADCAST_IDS, by_ids, free_names, passing, quoted, small_enough

#: Columns that operators read.
READ = ("text", "lang", "source", "n_chars")


def keyed(docs: DataFrame, key: str, keep: Callable) -> DataFrame:
    """``docs`` with ``key``, different in each row."""
    doc_id = F.col("doc_id").cast("long")
    if docs.groupBy(doc_id.alias("id")).agg(F.count("*").alias("n")).where("id is null or n > 1").isEmpty():
        return docs.withColumn(key, doc_id)
    at, own, first = free_names(docs, "at", "own", "first_at")
    rows = keep(docs.withColumn(at, F.monotonically_increasing_id()), "rows")  # written, so that a row keeps its number
    many = rows.groupBy(doc_id.alias(own)).agg(F.count("*").alias("n"), F.min(at).alias(first))
    many = keep(many.where(F.col(own).isNotNull() & (F.col("n") > 1)).select(own, first), "first")
    many = F.broadcast(many) if small_enough(many, BROADCAST_IDS) else many.hint("merge")
    top = rows.agg(F.max(doc_id)).first()[0]
    later = F.col("doc_id").isNull() | F.coalesce(F.col(first) != F.col(at), F.lit(False))
    beyond = F.lit(-1 if top is None else top).cast("long") + 1 + F.col(at)
    rows = rows.join(many, doc_id == F.col(own), "left").withColumn(key, F.when(later, beyond).otherwise(doc_id))
    return rows.select(*quoted(docs.columns), key)


def kept(docs: DataFrame, verdict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of ``docs`` that ``verdict``, an operator whose result has doc_id and kept, keeps."""
    (key,) = free_names(docs, "row")
    with passing(docs.sparkSession) as keep:
        rows = keyed(docs, key, keep)
        asked = rows.select(F.col(key).alias("doc_id"), *[c for c in READ if c in docs.columns])
        ids = keep(verdict(asked).where("kept").select(F.col("doc_id").alias(key)), "kept")
    return by_ids(rows, ids, key).select(*quoted(docs.columns))
