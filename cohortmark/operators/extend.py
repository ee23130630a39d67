"""Local alignments of oligos without gaps: exact seeds, extended both ways until the score drops.

Every exact run of at least ``word`` bases that an oligo shares with the database is a seed, on either strand. From the seed an alignment grows base by base on both
sides, by ``reward`` for a match and ``penalty`` for a mismatch, as long as its score is no more than ``drop`` below the best so far; it ends where
that best was. So a mismatch within a long alignment does not hide it, as a screen by exact words would.

Seeds meet the database in an equi-join. Where the database has few words they are looked up in the oligos first, and only seeds that they have become rows. A run gives one seed, its first: later words of the run grow into the same alignment. Candidates carry the bases around the
seed, as many as the longest oligo has, so no record is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmark.functions.sequence import reverse_complement

from . import places
from .search import CHUNK, LARGE, placed_windows
from .sequences import pieces, sized
from .storage import ship, stored

#: Most words of a database that are sent to all tasks, with the bases around them.
SENT_WORDS = 200_000


@dataclass(frozen=True)
class Extension:
    """Scores of matches and mismatches, the drop that ends an extension, and the length of seeds."""

    word: int = 11
    reward: int = 1
    penalty: int = -3
    drop: int = 10
    #: Lambda and K of ungapped scores 1 and -3.
    scale: float = 1.374
    k: float = 0.711


def reach(same: np.ndarray, begin: np.ndarray, e: Extension) -> np.ndarray:
    """How many of each row's matches and mismatches from ``begin`` on the best extension takes."""
    cols = np.arange(same.shape[1])
    score = np.cumsum(np.where(cols < begin[:, None], 0, np.where(same, e.reward, e.penalty)), 1)
    fall = np.maximum.accumulate(np.maximum(score, 0), 1) - score
    score = np.where(np.logical_or.accumulate(fall > e.drop, 1), 0, score)
    best = score.argmax(1)
    return np.where(score[np.arange(len(score)), best] > 0, best + 1 - begin, 0)


def grown(found: DataFrame, e: Extension) -> DataFrame:
    """query, seq_id, minus, n, start of the oligo in the record (``begin``) and the part of the oligo from ``a`` to ``b`` that the alignment of a seed at ``at`` takes, with
    its matches; oligo ``oseq`` and ``site`` are of one length."""
    ship(found.sparkSession)
    base = np.zeros(256, bool)
    base[list(b"ACGT")] = True

    def step(batches):
        for whole in batches:
            for batch in places.slices(whole, "oseq"):
                (o, ends), (s, starts), at = places.points(batch.column("oseq")), places.points(batch.column("site")), batch.column("at").to_numpy()
                n, a, b, matched = np.diff(ends), np.zeros(len(at), np.int32), np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
                for size in np.unique(n).tolist():
                    rows = np.flatnonzero(n == size)
                    x, y = o[ends[rows][:, None] + np.arange(size)], s[starts[rows][:, None] + np.arange(size)]
                    same, own = (x == y) & base[np.minimum(x, 255)], at[rows].astype(np.int64)
                    low, high = own - reach(same[:, ::-1], size - own, e), own + e.word + reach(same, own + e.word, e)
                    cols = np.arange(size)
                    a[rows], b[rows], matched[rows] = low, high, (same & (cols >= low[:, None]) & (cols < high[:, None])).sum(1)
                kept = [batch.column(c) for c in ("query", "seq_id", "minus", "n", "begin")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(a), pa.array(b), pa.array(matched)], names=["query", "seq_id", "minus", "n", "begin", "a", "b", "matched"])

    kinds = dict(found.dtypes)
    return found.mapInArrow(step, ", ".join(f"{c} {kinds[c]}" for c in ("query", "seq_id", "minus", "n", "begin")) + ", a int, b int, matched int")


def hits(oligos: DataFrame, database: DataFrame, e: Extension = Extension()) -> DataFrame:
    """Alignments of ``oligos`` (query, seq) with ``database`` (seq_id, seq), in the columns of hit tables. Places count from 1; on the minus strand
    sstart is greater than send. Only A, C, G and T match. Oligos shorter than a seed have none."""
    plus = stored(oligos.select("query", F.upper("seq").alias("oseq")), "oligos")  # read by several passes, and cut from texts that are long
    strands = F.array(F.struct(F.lit(False).alias("minus"), F.col("oseq")), F.struct(F.lit(True).alias("minus"), reverse_complement(F.col("oseq")).alias("oseq")))
    both = plus.select("query", F.explode(strands).alias("x")).select("query", "x.minus", "x.oseq", F.length("x.oseq").alias("n"))
    longest = both.agg(F.max("n")).first()[0] or e.word
    texts = database.select(F.lit("").alias("name"), "seq_id", F.upper("seq").alias("seq"))
    size = texts.agg(F.sum(F.length("seq"))).first()[0] or 0
    windows = placed_windows(pieces(texts, longest, longest + e.word, CHUNK, LARGE), e.word).where(F.col("kmer").rlike("^[ACGT]+$"))
    skip = F.greatest(F.col("p") - longest, F.lit(0))
    windows = windows.select("seq_id", (F.col("offset") - F.col("lead") + skip).alias("start"), (F.col("p") - skip).alias("p"), F.substring(F.col("seq"), skip + 1, F.col("p") - skip + e.word + longest).alias("seq"), "kmer")
    known = places.few(windows.select("kmer"), SENT_WORDS)
    if known is None:
        seeds = both.where(F.col("n") >= e.word).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n") - e.word)))
        seeds = seeds.withColumn("kmer", F.substring(F.col("oseq"), F.col("at") + 1, F.lit(e.word))).where(F.col("kmer").rlike("^[ACGT]+$"))
        found = windows.join(sized(seeds), "kmer")
    else:  # an oligo is one piece, shown whole around each of its seeds
        whole = pieces(both.select(F.col("query").alias("name"), F.col("minus").alias("seq_id"), F.col("oseq").alias("seq")), 0, 0, max(LARGE, longest), max(LARGE, longest))
        seeds = places.standing(whole, known, longest, longest).select(F.col("name").alias("query"), F.col("seq_id").alias("minus"), F.col("seq").alias("oseq"), F.length("seq").alias("n"), F.col("p").alias("at"))
        seeds = seeds.withColumn("kmer", F.substring(F.col("oseq"), F.col("at") + 1, F.lit(e.word)))
        found = seeds.join(F.broadcast(windows), "kmer")
    found = found.withColumn("first", F.col("p") - F.col("at"))
    before = (F.col("at") > 0) & (F.col("p") > 0) & (F.substring(F.col("oseq"), F.col("at"), F.lit(1)) == F.substring(F.col("seq"), F.col("p"), F.lit(1)))
    found = found.where(~(before & F.substring(F.col("oseq"), F.col("at"), F.lit(1)).rlike("[ACGT]")))
    missing = F.greatest(-F.col("first"), F.lit(0))
    site = F.rpad(F.concat(F.repeat(F.lit("-"), missing), F.substring(F.col("seq"), F.greatest("first", F.lit(0)) + 1, F.col("n") - missing)), F.col("n"), F.lit("-"))
    found = grown(found.select("query", "seq_id", "minus", "n", (F.col("start") + F.col("first")).alias("begin"), "at", "oseq", site.alias("site")), e)
    found = found.select("query", "seq_id", "minus", "n", "a", "b", "matched", (F.col("begin") + F.col("a") + 1).cast("long").alias("low"), (F.col("begin") + F.col("b")).cast("long").alias("high")).distinct()
    length, score = F.col("b") - F.col("a"), e.reward * F.col("matched") + e.penalty * (F.col("b") - F.col("a") - F.col("matched"))
    bits = (e.scale * score - F.log(F.lit(e.k))) / F.log(F.lit(2.0))
    way = lambda x, y: F.when(F.col("minus"), x).otherwise(y)
    return found.select(
        "query", F.col("seq_id").alias("subject"), F.round(100.0 * F.col("matched") / length, 3).alias("pident"), length.alias("length"), (length - F.col("matched")).alias("mismatch"), F.lit(0).alias("gapopen"),
        way(F.col("n") - F.col("b") + 1, F.col("a") + 1).alias("qstart"), way(F.col("n") - F.col("a"), F.col("b")).alias("qend"), way(F.col("high"), F.col("low")).alias("sstart"), way(F.col("low"), F.col("high")).alias("send"),
        (F.col("n") * F.lit(float(size)) * F.pow(F.lit(2.0), -bits)).alias("evalue"), F.round(bits, 1).alias("bitscore"),
    )


def primer_oligos(primers: DataFrame) -> DataFrame:
    """query, seq: the oligos of pairs, named as hit tables name them."""
    arms = F.array(*[F.struct(F.lit(f"_{tag}").alias("tag"), F.col(f"{arm}_seq").alias("seq")) for arm, tag in (("forward", "fwd"), ("reverse", "rev"), ("internal", "int")) if f"{arm}_seq" in primers.columns])
    return primers.select("name", F.explode(arms).alias("x")).where("coalesce(x.seq, '') <> ''").select(F.concat("name", "x.tag").alias("query"), "x.seq")


def screen(primers: DataFrame, database: DataFrame, max_alignment: int = 15, e: Extension = Extension()) -> DataFrame:
    """Pairs none of whose oligos has an alignment with the database longer than ``max_alignment``."""
    primers = stored(primers, "primers")
    bad = hits(primer_oligos(primers), database, e).where(F.col("length") > max_alignment)
    return primers.join(bad.select(F.regexp_replace("query", "_(fwd|rev|int)$", "").alias("name")).distinct(), "name", "left_anti")
