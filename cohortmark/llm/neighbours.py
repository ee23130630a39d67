"""Approximate nearest neighbours by cosine with multi-index hashing.

Vectors become codes of BITS signs along learned axes: the leading axes of a sample, turned by iterative quantisation so that signs lose little of
the angles. A code is cut into substrings of 16 bits and each substring has an index of its own, from value to rows. Two codes at most r bits apart have, by the pigeonhole
principle, a substring pair at most r // m bits apart (of m substrings, the first r % m + 1 at r // m, the others at r // m - 1): probing these values finds *every* code
within the radius, and what is found is ranked by the vectors themselves.

The radius of a query follows from the angle of the worst neighbour found so far: the bits that true neighbours at that angle differ by in the sample,
with a margin that PART of them keep. It starts from the neighbours within the sample, which are results until better ones
are found, and then shrinks. Where vectors have near neighbours, few buckets are probed; where nothing is near, as among random directions, the radius is a large
part of the code and most buckets are.

Equal vectors are one entry of the index with their least vec_ids, as many as a result can hold, combined in each batch, then in salted groups, then globally. So
copies cost one search. Queries are one entry for each different vector too. They go out in slices of bounded size, each a pass over the index.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without vec_id, take no part. Vectors of different lengths are never compared.
Repeated rows, and rows that share a vec_id, are rows of their own: each asks, and finds the others. Ties go to the smaller vec_id. Empty tables give an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import join_skewed, passing, per_batch, stored

#: Results of a query; rows whose vec_id is divisible by EVERY ask.
NEAREST, EVERY = 5, 50
#: Bits of a code, a multiple of 64, in substrings of SUB bits.
BITS, SUB = 128, 16
#: Different vectors that the axes and radii are learned from; how many of their true neighbours a radius must reach.
SAMPLE, PART = 4096, 0.985
#: Numbers that the queries of a slice, and what a step compares them with, hold.
SLICE_VALUES, STEP_PAIRS = 1 << 22, 1 << 22
#: Rows of a file of the index.
FILE_ROWS = 8192
SALTS = 16
_BITS_SET = np.array([bin(i).count("1") for i in range(1 << SUB)], np.uint8)


@dataclass
class Coder:
    """Learned axes, and the law of bits against angle."""

    axes: np.ndarray
    slope: float
    margin: float

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(n, BITS / 64) words."""
        return np.packbits(unit @ self.axes > 0, axis=1, bitorder="little").view(np.uint64)

    def radius(self, cosine: np.ndarray) -> np.ndarray:
        """Within how many bits the neighbours at ``cosine`` lie."""
        p = np.arccos(np.clip(cosine, -1, 1)) / np.pi
        return np.where(cosine < -1, BITS, np.minimum(self.slope * BITS * p + self.margin * np.sqrt(BITS * p * (1 - p) + 1), BITS)).astype(np.int64)


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all pairs of codes."""
    out = np.zeros((len(a), len(b)), np.int16)
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
    return out


def learned(unit: np.ndarray, rounds: int = 20, seed: int = 11) -> Coder:
    """Axes from the unit vectors of a sample by iterative quantisation; as many turns of the leading axes as BITS asks for."""
    rng, d = np.random.default_rng(seed), unit.shape[1]
    leading = np.linalg.eigh(unit.T @ unit)[1][:, ::-1][:, :BITS] if len(unit) else np.eye(d)[:, :BITS]
    flat, parts = unit @ leading, []
    for _ in range(-(-BITS // leading.shape[1])):
        turn = np.linalg.qr(rng.normal(size=(flat.shape[1],) * 2))[0]
        for _ in range(rounds if len(unit) else 0):
            u, _, v = np.linalg.svd(flat.T @ np.where(flat @ turn > 0, 1.0, -1.0))
            turn = u @ v
        parts.append(leading @ turn)
    coder = Coder(np.hstack(parts)[:, :BITS], 1.0, 3.0)
    some = unit[:512]
    if len(unit) > 50:
        cosine = some @ unit.T
        cosine[np.arange(len(some)), np.arange(len(some))] = -2
        near = np.argpartition(-cosine, NEAREST, axis=1)[:, :NEAREST]
        code = coder.codes(unit)
        h = np.take_along_axis(bits_apart(code[: len(some)], code), near, 1).ravel().astype(float)
        p = np.arccos(np.clip(np.take_along_axis(cosine, near, 1).ravel(), -1, 1)) / np.pi
        coder.slope = float((h * p).sum() / max((BITS * p * p).sum(), 1e-9))
        coder.margin = float(max(np.quantile((h - coder.slope * BITS * p) / np.sqrt(BITS * p * (1 - p) + 1), PART), 1.0))
    return coder


def _masks() -> tuple[np.ndarray, np.ndarray]:
    """All values of a substring by their number of bits, and how many there are with at most 0, 1, 2 ... bits."""
    order = np.concatenate([np.array([sum(1 << i for i in c) for c in combinations(range(SUB), k)], np.uint16) for k in range(4)])
    return order, np.cumsum([1, 16, 120, 560])


_MASKS, _WITHIN = _masks()


def substring_radii(radius: np.ndarray, m: int) -> np.ndarray:
    """(queries, m): how near a substring must be, so that no code within ``radius`` is missed; -1: not looked at."""
    whole, rest = np.divmod(radius, m)
    return np.where(np.arange(m)[None, :] <= rest[:, None], whole[:, None], whole[:, None] - 1)


class Buckets:
    """The substring indexes of some codes: for each substring its values, and the rows of each value."""

    def __init__(self, codes: np.ndarray):
        self.n, self.parts = len(codes), codes.view(np.uint16)
        self.values, self.at, self.order, self.begin = [], [], [], []
        for j in range(self.parts.shape[1]):
            values, at, count = np.unique(self.parts[:, j], return_inverse=True, return_counts=True)
            self.values.append(values)
            self.at.append(at)
            self.order.append(np.argsort(at, kind="stable"))
            self.begin.append(np.concatenate(([0], np.cumsum(count))))
        self.table: list[np.ndarray | None] = [None] * self.parts.shape[1]

    def narrow(self, radii: np.ndarray) -> np.ndarray:
        """Queries with fewer values to probe than there are."""
        worst = radii.max(1)
        return (worst < len(_WITHIN)) & (_WITHIN[np.clip(worst, 0, len(_WITHIN) - 1)] * 2 < self.n)

    def probe(self, query: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """Rows with a substring within its radius of the query's, by enumeration of the values to look at."""
        found = []
        for j, r in enumerate(radii.tolist()):
            if r < 0:
                continue
            if self.table[j] is None:
                self.table[j] = np.full(1 << SUB, -1, np.int32)
                self.table[j][self.values[j]] = np.arange(len(self.values[j]))
            hit = self.table[j][query[j] ^ _MASKS[: _WITHIN[r]]]
            for b in hit[hit >= 0].tolist():
                found.append(self.order[j][self.begin[j][b] : self.begin[j][b + 1]])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def wide(self, queries: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """The same for many queries whose values outnumber the buckets: all buckets are held against them. (queries, rows)"""
        hit = np.zeros((len(queries), self.n), bool)
        for j in range(queries.shape[1]):
            near = _BITS_SET[queries[:, j, None] ^ self.values[j][None, :]].astype(np.int16) <= radii[:, j, None]
            hit |= near[:, self.at[j]]
        return hit


def within(buckets: Buckets, codes: np.ndarray, queries: np.ndarray, radius: np.ndarray):
    """(query, row) of all codes within each query's radius."""
    radii = substring_radii(radius, buckets.parts.shape[1])
    parts = queries.view(np.uint16)
    narrow = buckets.narrow(radii)
    qs, rows = [], []
    for i in np.flatnonzero(narrow).tolist():
        found = buckets.probe(parts[i], radii[i])
        found = found[bits_apart(queries[i : i + 1], codes[found])[0] <= radius[i]]
        qs.append(np.full(len(found), i))
        rows.append(found)
    many = np.flatnonzero(~narrow)
    step = max(1, STEP_PAIRS // max(len(codes), 1))
    for s in range(0, len(many), step):
        own = many[s : s + step]
        hit = buckets.wide(parts[own], radii[own])
        hit &= bits_apart(queries[own], codes) <= radius[own, None]
        q, r = np.nonzero(hit)
        qs.append(own[q])
        rows.append(r)
    return (np.concatenate(qs), np.concatenate(rows)) if qs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Slice:
    """Query vectors (scaled by powers of two), their keys and norms, the cosine that their worst neighbour has at least, and which queries each vector of
    the sample is a neighbour of."""

    keys: list[str]
    vectors: np.ndarray
    norms: np.ndarray
    worst: np.ndarray
    seeds: dict[str, list[int]]


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times powers of two, so that no square over- or underflows, and their norms."""
    v = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None]) if len(vectors) else vectors
    return v, np.sqrt(np.einsum("ij,ij->i", v, v))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, d)


def best_of(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, own: np.ndarray, most: int):
    """The ``most`` best entries of each query, sorted by query."""
    order = np.lexsort((vec_id, -score, query))
    query, score, vec_id, own = query[order], score[order], vec_id[order], own[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    keep = place < most
    return query[keep], score[keep], vec_id[keep], own[keep]


def _search(batches, q: Slice, coder: Coder, most: int):
    d = q.vectors.shape[1]
    unit = q.vectors / q.norms[:, None]
    codes, worst, known = coder.codes(unit), q.worst.copy(), {k: i for i, k in enumerate(q.keys)}
    best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool))
    for batch in batches:
        if not batch.num_rows:
            continue
        v, norm = scaled(matrix(batch.column("vec"), d))
        own_codes = coder.codes(v / norm[:, None])
        keys = batch.column("key").to_pylist()
        same = np.array([known.get(k, -1) for k in keys])
        qs, rows = within(Buckets(own_codes), own_codes, codes, coder.radius(worst))
        seeded = np.array([i * len(keys) + r for r, k in enumerate(keys) for i in q.seeds.get(k, ())], np.int64)
        if len(seeded):  # the sample's neighbours, so that a narrow radius never leaves a query with fewer results
            qs, rows = np.divmod(np.union1d(qs * len(keys) + rows, seeded), len(keys))
        step = max(1, STEP_PAIRS // d)
        score = np.concatenate([np.einsum("ij,ij->i", q.vectors[qs[s : s + step]], v[rows[s : s + step]]) for s in range(0, len(qs), step)] or [np.zeros(0)])
        score /= q.norms[qs] * norm[rows]
        keep = score >= worst[qs] - 1e-9
        qs, rows, score = qs[keep], rows[keep], score[keep]
        ids = batch.column("ids")
        size = pc.list_value_length(ids).to_numpy()[rows]
        begin = ids.offsets.to_numpy()[:-1][rows] - ids.offsets[0].as_py()
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        new = (np.repeat(qs, size), np.repeat(score, size), ids.flatten().to_numpy()[at], np.repeat(same[rows] == qs, size))
        best = best_of(*(np.concatenate(p) for p in zip(best, new, strict=True)), most)
        full = np.flatnonzero(np.bincount(best[0], minlength=len(worst)) == most)
        last = np.searchsorted(best[0], full, "right") - 1
        worst[full] = np.maximum(worst[full], best[1][last])
    cols = [pa.array([q.keys[i] for i in best[0].tolist()], pa.string()), pa.array(best[1]), pa.array(best[2]), pa.array(best[3])]
    yield pa.RecordBatch.from_arrays(cols, names=["key", "score", "vec_id", "own"])


def _combined(batches, most: int):
    """Equal vectors of a batch: the vector and its least ids."""
    for batch in batches:
        column = batch.column("vec")
        values, off = column.flatten().to_numpy(zero_copy_only=False) + 0.0, column.offsets.to_numpy() - column.offsets[0].as_py()
        found: dict[bytes, list[int]] = {}
        for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
            found.setdefault(values[off[i] : off[i + 1]].tobytes(), []).append(vec_id)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([sorted(x)[:most] for x in found.values()], pa.list_(pa.int64()))], names=["vec", "ids"])


def _keys(batches):
    for batch in batches:
        column = batch.column("vec")
        values, off = column.flatten().to_numpy(zero_copy_only=False) + 0.0, column.offsets.to_numpy() - column.offsets[0].as_py()
        keys = [hashlib.md5(values[off[i] : off[i + 1]].tobytes()).hexdigest() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.string())], names=["query_id", "key"])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vec: the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vec", lambda x: x != 0), F.lit(False)))


def index(rows: DataFrame, most: int) -> DataFrame:
    """key, vec, dim, ids: the different vectors and their ``most`` least ids."""
    found = per_batch(rows, lambda b: _combined(b, most), "vec binary, ids array<long>")
    least = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, most).alias("ids")
    found = found.groupBy("vec", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")).agg(least).groupBy("vec").agg(least)
    return found.select(F.md5("vec").alias("key"), "vec", F.expr("int(octet_length(vec) / 8)").alias("dim"), "ids")


def _slices(asked: DataFrame, sample: np.ndarray, names: list[str], d: int, most: int):
    size = max(1, SLICE_VALUES // d)
    parts = max(1, -(-asked.count() // size))
    for i in range(parts):
        own = asked.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == i).toArrow().combine_chunks()
        v, norm = scaled(matrix(own.column("vec"), d))
        worst, seeds = np.full(len(v), -2.0), {}
        for s in range(0, len(v) if len(sample) >= most else 0, 1024):
            cosine = v[s : s + 1024] / norm[s : s + 1024, None] @ sample.T
            near = np.argpartition(-cosine, most - 1, axis=1)[:, :most]
            worst[s : s + 1024] = np.take_along_axis(cosine, near, 1).min(1)
            for k, row in enumerate(near.tolist()):
                for at in row:
                    seeds.setdefault(names[at], []).append(s + k)
        if len(v):
            yield Slice(own.column("key").to_pylist(), v, norm, worst, seeds)


def nearest(vectors: DataFrame, every: int = EVERY, n: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id, embedding) whose vec_id ``every`` divides, the ``n`` nearest rows found."""
    most = n + 1  # the query itself may be among them
    with passing(vectors.sparkSession) as keep:
        rows = usable(vectors)
        found = stored(index(rows, most), "vectors")
        found = stored(found.repartition(max(1, -(-found.count() // FILE_ROWS))), "index")
        queries = stored(per_batch(rows.where(F.col("vec_id") % every == 0), _keys, "query_id long, key string"), "queries")
        asked = found.join(queries.select("key").distinct(), "key", "left_semi").select("key", "vec", "dim")
        out = None
        for d in sorted(r[0] for r in found.select("dim").distinct().collect()):
            own = found.where(F.col("dim") == d)
            some = own.orderBy(F.xxhash64("vec")).limit(SAMPLE).select("key", "vec").toArrow().combine_chunks()
            sample, norm = scaled(matrix(some.column("vec"), d))
            sample, names = sample / norm[:, None], some.column("key").to_pylist()
            coder = learned(sample)
            for q in _slices(asked.where(F.col("dim") == d), sample, names, d, most):
                sent = vectors.sparkSession.sparkContext.broadcast(q)
                got = stored(per_batch(own.select("key", "vec", "ids"), lambda b, sent=sent, coder=coder: _search(b, sent.value, coder, most), "key string, score double, vec_id long, own boolean"), "near")
                out = got if out is None else out.union(got)
        if out is None:
            return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc(), "vec_id"))
        best = out.withColumn("rank", rank).where(F.col("rank") <= most)
        best = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score", "own"))).alias("near"))
        each = join_skewed(queries, best, "key")
        mine = F.array_position(F.transform("near", lambda e: e["own"] & (e["vec_id"] == F.col("query_id"))), True)
        each = each.withColumn("mine", mine).withColumn("near", F.slice(F.filter("near", lambda e, i: i + 1 != F.col("mine")), 1, n))
        each = each.select("query_id", F.posexplode("near").alias("at", "x"))
        return keep(each.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")), "nearest")
