"""Exact deduplication by skew-safe combining, in DataFrame functions only.

Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``; null counts as an empty text. Of equal texts the row
with the most code points in the original stays, then the smallest doc_id.

Three stages, each of which groups by the digest *and* the full normalised text: copies inside one task combine before
anything is sent, (digest, salt) groups combine what tasks found, and the winners of the salts combine globally. A key that
holds a third of all rows is thus one row for each task, then one for each salt. Rows then look up their group by digest. Should two
different texts ever share a digest, the lookup compares texts as well.

Repeated rows count as separate members, the smallest doc_id wins ties. Rows with a null doc_id are members too and lose ties;
where one stays, keep_id is null. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, join_skewed

SPACE = r"[\x20\x09-\x0D]+"
SALTS = 16
#: Ranks are n_chars * SCALE - doc_id; both fit a decimal, which an aggregation can update in place.
SCALE = "20000000000000000000"
BIG = "9223372036854775807"


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row for each different text: text_sha256, norm, keep_rank, group_size."""
    doc_id = F.coalesce(F.col("doc_id"), F.lit(int(BIG)))
    rank = F.length(F.coalesce("text", F.lit(""))).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(20,0)") - doc_id.cast("decimal(19,0)")
    rows = docs.select(normalised(F.col("text")).alias("norm"), rank.cast("decimal(38,0)").alias("rank"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    rows = rows.withColumn("text_sha256", F.sha2("norm", 256))
    salted = rows.groupBy("text_sha256", "norm", "salt").agg(F.max("rank").alias("rank"), F.count("*").alias("n"))
    return salted.groupBy("text_sha256", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"))


def exact_dup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = groups(docs, salts)
    found = found.groupBy("text_sha256").agg(F.max("rank").alias("rank"), F.max("group_size").alias("group_size"), F.count("*").alias("texts"))
    found = cut(found)
    rows = docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    if found.where("texts > 1").isEmpty():
        out = join_skewed(rows, found.select("text_sha256", "rank", "group_size"), "text_sha256")
    else:  # digests that different texts share: the full text decides
        full = docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256"), normalised(F.col("text")).alias("norm"))
        out = full.join(groups(docs, salts), ["text_sha256", "norm"]).drop("norm")
    # rank = n * SCALE - doc_id with |doc_id| < SCALE / 2
    scale = F.lit(SCALE).cast("decimal(20,0)")
    n = F.floor((F.col("rank") + F.lit(BIG).cast("decimal(19,0)")) / scale).cast("decimal(18,0)")
    keep = (n * scale - F.col("rank")).cast("long")
    out = out.withColumn("keep_id", F.when(keep == int(BIG), F.lit(None).cast("long")).otherwise(keep))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
