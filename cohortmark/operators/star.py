"""Multiple alignment of a primer's amplicons around a centre, without gathering them.

The centre of a primer is its most frequent sequence (ties: the longer, then the first in order). Every different sequence is aligned with it, an optimal global alignment
with affine gaps, in batches of pairs wherever they lie. The most gaps that any alignment has before a place of the centre decide how many columns stand there: a small
aggregation by (primer, place). Then each row is spread to these columns by itself. A primer with a third of all amplicons is many pairs in many tasks.

Primers of few amplicons take none of these steps: their amplicons meet in one exchange, and each batch of whole primers is aligned and spread where it is.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import align, scans
from .sequences import sized
from .storage import ship, stored

#: Most amplicons of a primer that one task aligns.
SALTS, FEW = 16, 2000
GAPS = re.compile("-+")
PLACES = pa.list_(pa.struct([("place", pa.int32()), ("n", pa.int32())]))


def centres(amplicons: DataFrame) -> DataFrame:
    """primer, centre."""
    each = amplicons.groupBy("primer", "seq").agg(F.count("*").alias("n"))
    best = F.max_by("seq", F.struct("n", F.length("seq"), F.hex("seq"))).alias("centre")
    return each.groupBy("primer").agg(best)


def _gaps(centre: str) -> list[tuple[int, int]]:
    """(place, n) of each run of gaps: how many bases of the centre stand before it, and how long it is."""
    found, before = [], 0
    for gap in GAPS.finditer(centre):
        n = gap.end() - gap.start()
        found.append((gap.start() - before, n))
        before += n
    return found


def _pairs(batches, scores: align.Scores):
    for batch in batches:
        found = align.aligned(batch.column("centre").to_pylist(), batch.column("seq").to_pylist(), scores)
        gaps = pa.array([_gaps(x) for x, _, _ in found], PLACES)
        cols = [batch.column("primer"), batch.column("seq"), pa.array([x for x, _, _ in found], pa.string()), pa.array([y for _, y, _ in found], pa.string()), pa.array([s for *_, s in found], pa.int64())]
        yield pa.RecordBatch.from_arrays([*cols, gaps], names=["primer", "seq", "centre_row", "own_row", "score", "gaps"])


def _widened(centre: str, own: str, wide: dict[int, int]) -> str:
    """``own``, aligned with ``centre``, with ``wide[place]`` columns before each place of the centre."""
    if not wide:
        return own
    had, row, at, gone = dict(_gaps(centre)), [], 0, 0
    for place in sorted(wide):
        n = had.get(place, 0)
        end = place + gone + n
        row += [own[at:end], "-" * (wide[place] - n)]
        at, gone = end, gone + n
    return "".join(row) + own[at:]


def _spread(batches):
    """Rows with as many columns before each place of the centre as the primer's widest alignment has there."""
    for batch in batches:
        gaps = batch.column("wide")
        ends, place, n = gaps.offsets.to_pylist(), gaps.values.field("place").to_pylist(), gaps.values.field("n").to_pylist()
        rows = zip(batch.column("centre_row").to_pylist(), batch.column("own_row").to_pylist(), ends, ends[1:], strict=False)
        out = [_widened(centre, own, dict(zip(place[a:b], n[a:b], strict=True))) for centre, own, a, b in rows]
        yield pa.RecordBatch.from_arrays([batch.column("primer"), batch.column("seq"), pa.array(out, pa.string())], names=["primer", "seq", "aligned"])


def pair_alignments(amplicons: DataFrame, scores: align.Scores = align.Scores()) -> DataFrame:
    """primer, seq, centre_row, own_row, score, gaps: each different sequence of a primer aligned with its centre; gaps (place, n) of the centre, by its bases before them."""
    ship(amplicons.sparkSession)
    each = amplicons.select("primer", "seq").distinct()
    middle = centres(amplicons).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = each.withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int")).join(middle, ["primer", "salt"])
    return each.select("primer", "seq", "centre").mapInArrow(lambda b: _pairs(b, scores), "primer string, seq string, centre_row string, own_row string, score long, gaps array<struct<place: int, n: int>>")


def _aligned_rows(seqs: list[str], begin: list[int], scores: align.Scores) -> list[str]:
    """``seqs``, of which each primer has a run from one ``begin`` to the next, as rows of one length for each."""
    groups, xs, ys = [], [], []
    known = scores.match >= max(scores.mismatch, 0) and max(scores.open, scores.extend) <= 0  # nothing is better than a centre with itself
    for s, e in zip(begin, [*begin[1:], len(seqs)], strict=True):
        n = Counter(seqs[s:e])
        centre = max(n, key=lambda t, n=n: (n[t], len(t), t.encode()))
        others = [t for t in n if t != centre or not known]
        groups.append((s, e, centre, others))
        xs += [centre] * len(others)
        ys += others
    found, out = iter(align.aligned(xs, ys, scores)), []
    for s, e, centre, others in groups:
        rows = {centre: (centre, centre)} | {t: next(found)[:2] for t in others}
        wide: dict[int, int] = {}
        for x, _ in rows.values():
            for place, n in _gaps(x):
                wide[place] = max(wide.get(place, 0), n)
        rows = {t: _widened(x, y, wide) for t, (x, y) in rows.items()}
        out += [rows[t] for t in seqs[s:e]]
    return out


def _together(batches, scores: align.Scores):
    """Rows sorted by primer with ``seq`` aligned; a primer that a batch may not hold whole waits for the next."""
    held = None

    def done(table: pa.Table):
        begin = np.flatnonzero(scans.fresh_keys(table, ["primer"])).tolist()
        rows = pa.array(_aligned_rows(table.column("seq").to_pylist(), begin, scores), pa.string())
        return table.set_column(table.schema.get_field_index("seq"), "seq", rows).to_batches()

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if table.num_rows:
            last = int(np.flatnonzero(scans.fresh_keys(table, ["primer"]))[-1])
            held = table.slice(last)
            if last:
                yield from done(table.slice(0, last))
    if held is not None:
        yield from done(held)


def align_amplicons(amplicons: DataFrame, scores: align.Scores = align.Scores(), few: int = FEW) -> DataFrame:
    """``amplicons`` (primer, amplicon_name, seq) with ``seq`` as rows of one length for each primer, gaps as ``-``: input for distances and for alignment files.

    A primer with one amplicon, or with equal ones, keeps its sequence. Equal sequences have equal rows. ``few``: most amplicons of a primer that one task aligns.
    """
    ship(amplicons.sparkSession)
    given = stored(amplicons.where("primer is not null and seq is not null"), "amplicons")
    many = stored(given.groupBy("primer").agg(F.count("*").alias("n")).where(F.col("n") > few).select("primer"), "many")
    if many.isEmpty():
        return _near(given, scores)
    many = sized(many)
    return _near(given.join(many, "primer", "left_anti"), scores).unionByName(_spread_out(given.join(many, "primer", "left_semi"), scores))


def _near(amplicons: DataFrame, scores: align.Scores) -> DataFrame:
    """Aligned rows of primers of few amplicons."""
    spark = amplicons.sparkSession  # few bytes and much work: by their bytes a few tasks would get them all
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return amplicons.repartition(parts, "primer").sortWithinPartitions("primer").mapInArrow(lambda b: _together(b, scores), amplicons.schema)


def _spread_out(amplicons: DataFrame, scores: align.Scores) -> DataFrame:
    """Aligned rows of primers of many amplicons: pairs, columns and rows are dealt out each by themselves."""
    pairs = stored(pair_alignments(amplicons, scores), "pairs")
    widest = pairs.select("primer", F.explode("gaps").alias("x")).groupBy("primer", "x.place").agg(F.max("x.n").alias("n"))
    widest = widest.groupBy("primer").agg(F.collect_list(F.struct("place", "n")).alias("wide"))
    rows = pairs.join(widest, "primer", "left").select("primer", "seq", "centre_row", "own_row", "wide")
    rows = rows.mapInArrow(_spread, "primer string, seq string, aligned string")
    return amplicons.join(rows, ["primer", "seq"]).withColumn("seq", F.col("aligned")).select(amplicons.columns)


def column_profile(aligned: DataFrame) -> DataFrame:
    """primer, place, base, n: how often each base or gap stands in each column of a primer's alignment."""
    rows = aligned.groupBy("primer", "seq").agg(F.count("*").alias("n"))
    return rows.select("primer", F.posexplode(F.split("seq", "")).alias("place", "base"), "n").where("base <> ''").groupBy("primer", "place", "base").agg(F.sum("n").alias("n"))


def consensus(aligned: DataFrame) -> DataFrame:
    """primer, consensus: the most frequent base of each column (ties: the first in order), gaps left out."""
    best = Window.partitionBy("primer", "place").orderBy(F.col("n").desc(), "base")
    rows = column_profile(aligned).withColumn("k", F.row_number().over(best)).where("k = 1")
    rows = rows.groupBy("primer").agg(F.array_sort(F.collect_list(F.struct("place", "base"))).alias("x"))
    return rows.select("primer", F.translate(F.array_join(F.transform("x", lambda x: x["base"]), ""), "-", "").alias("consensus"))
