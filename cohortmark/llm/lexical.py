"""Ranked lexical search by MaxScore with bounds of term pairs.

Documents become blocks of posting lists; each block also keeps, for chosen pairs of query terms, the joint maximum of the list that both terms share: the
largest sum of their two impacts in one document. A query bounds what a set of terms can add by combining these: two terms that never meet in a block add
no more than the larger of them, whatever their own maxima add up to. Blocks whose bound stays below a threshold are passed by; in the others, terms from
the lightest on that cannot reach the threshold together are only looked up for documents that heavier terms found.

1. ``postings``: one pass over all texts makes blocks of at most BLOCK_DOCS documents, with the postings of the query terms and the number of all terms.
2. ``index``: with the counts of the whole table come impacts, maxima, pair lists and a bound for each item and block.
3. ``thresholds``: each item's block of the highest bound is scored in full; its 50th best score is a threshold for the rest.
4. ``search``: all blocks, with a threshold that rises within a task; each task gives its best of each item, and a window with a limit ranks them.

Items come in slices of bounded size, each with passes of its own. Terms, ranks and scores follow the contract of the query: integers but for one logarithm.
Terms are told apart by 64-bit hashes.

Rows that share an item_id are one item with the terms of all; an item without terms has no row. Null texts have no terms. Repeated rows, and rows that
share a doc_id, are documents of their own, in any order where they tie; a null doc_id comes after all others. Empty tables give an empty result. Very long texts
are a step of their own. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytescan as B
from .runtime import passing, per_batch, stored, text_steps

#: Results of an item.
TOP = 50
#: Most documents and, but for the last document's, postings of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 500_000
#: Most terms of the items of a slice, counted for each item (an item with more is a slice of its own).
SLICE_TERMS = 200_000
#: All pairs of so many of an item's heaviest terms get lists, and neighbours in weight among the others.
HEAVY = 8
#: Fixed value: the characters of terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_INSIDE = np.ones(256, bool)
_INSIDE[:128] = [chr(i).isalnum() for i in range(128)]
_LAST = np.iinfo(np.int64).max
_BLOCK = "block long, doc_id array<long>, n array<long>, terms array<int>, begin array<int>, doc array<int>, tf array<long>, docs long, words long"
_INDEX = "block long, doc_id array<long>, terms array<int>, begin array<int>, doc array<int>, impact array<long>, joint array<long>, bound array<long>"


def term_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, last byte and row of each term of the texts data[off[i]:off[i + 1]]."""
    inside = _INSIDE[data]
    starts, ends = inside.copy(), inside.copy()
    if len(data):
        begin = np.zeros(len(data) + 1, bool)
        begin[off[:-1]] = True
        starts[1:] &= ~inside[:-1] | begin[1:-1]
        ends[:-1] &= ~inside[1:] | begin[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    return first, last, np.searchsorted(off, first, "right") - 1


def term_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each term, A-Z lower-cased."""
    low = B.LOWER[data]
    first, last, row = term_spans(low, off)
    return B.span_hashes(low, first, last), row


@dataclass
class Queries:
    """A slice of the items: sorted hashes of its terms, each item's terms as places among them, and once ``weigh`` ran, weights and pairs."""

    ids: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    weight: np.ndarray = None
    N: int = 0
    L: int = 1
    pairs: np.ndarray = None  # (n, 2), places of two terms, the smaller first
    own: list[np.ndarray] = field(default_factory=list)  # for each item: which pairs are of its terms
    theta: np.ndarray = None

    def weigh(self, df: np.ndarray, N: int, L: int) -> None:
        self.N, self.L = N, max(L, 1)
        self.weight = np.array([math.floor(1000 * math.log((2 * N + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        chosen: dict[tuple[int, int], int] = {}
        for terms in self.terms:
            by = terms[np.argsort(-self.weight[terms], kind="stable")].tolist()
            two = [(a, b) for i, a in enumerate(by[:HEAVY]) for b in by[i + 1 : HEAVY]] + list(zip(by[HEAVY::2], by[HEAVY + 1 :: 2], strict=False))
            self.own.append(np.array([chosen.setdefault((min(p), max(p)), len(chosen)) for p in two], np.int64))
        self.pairs = np.array(list(chosen), np.int64).reshape(-1, 2)
        self.theta = np.zeros(len(self.ids), np.int64)

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 50 + (50 * n * self.N) // self.L
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def slices(items: DataFrame):
    """The items in runs of bounded size, as Queries."""
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term")).distinct()
    rows = stored(rows, "terms")
    parts = max(1, -(-rows.count() // SLICE_TERMS))
    for i in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == i).groupBy("item_id").agg(F.collect_list("term").alias("terms")).toArrow()
        terms = own.column("terms").combine_chunks()
        data = [t.encode() for t in terms.flatten().to_pylist()]
        size = np.array([len(t) for t in data], np.int64)
        last = np.cumsum(size) - 1
        h = B.span_hashes(np.frombuffer(b"".join(data), np.uint8), last - size + 1, last)
        vocabulary, place = np.unique(h, return_inverse=True)
        yield Queries(own.column("item_id").to_pylist(), vocabulary, np.split(place, np.cumsum([len(t) for t in terms.to_pylist()])[:-1]) if len(own) else [])


def _postings(batches, q: Queries):
    part = None
    for batch in batches:
        ids = batch.column("doc_id")
        part = int(batch.column("part")[0].as_py()) << 32 if part is None and batch.num_rows else part
        for i, j, data, off in text_steps(batch.column("text")):
            h, row = term_hashes(data, off)
            n = np.bincount(row, minlength=j - i).astype(np.int64)
            at = np.minimum(np.searchsorted(q.vocabulary, h), max(len(q.vocabulary) - 1, 0))
            hit = q.vocabulary[at] == h if len(q.vocabulary) else np.zeros(len(h), bool)
            key, tf = np.unique(row[hit] * len(q.vocabulary) + at[hit], return_counts=True)
            row, term = np.divmod(key, max(len(q.vocabulary), 1))
            size = np.cumsum(np.bincount(row, minlength=j - i))
            r = 0
            while r < j - i:
                have = size[r - 1] if r else 0
                e = max(r + 1, min(r + BLOCK_DOCS, int(np.searchsorted(size, have + BLOCK_POSTINGS, "right"))))
                own = slice(have, size[e - 1])
                order = np.argsort(term[own], kind="stable")
                terms, begin = np.unique(term[own], return_index=False), None
                begin = np.searchsorted(term[own][order], np.append(terms, len(q.vocabulary) + 1))
                yield pa.RecordBatch.from_pylist([{
                    "block": part, "doc_id": ids.slice(i + r, e - r).to_pylist(), "n": n[r:e], "terms": terms.astype(np.int32), "begin": begin.astype(np.int32),
                    "doc": (row[own][order] - r).astype(np.int32), "tf": tf[own][order].astype(np.int64), "docs": int((n[r:e] > 0).sum()), "words": int(n[r:e].sum()),
                }], _arrow(_BLOCK))
                part, r = part + 1, e


def _arrow(schema: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, types[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _numbers(batch, name: str, r: int) -> np.ndarray:
    return batch.column(name)[r].values.to_numpy(zero_copy_only=False)


class Block:
    """The posting lists of a block; ``u`` holds the largest impact of each term of the slice, ``at`` its list or -1."""

    def __init__(self, q: Queries, terms, begin, doc, impact, joint=None):
        self.q, self.begin, self.doc, self.impact, self.joint = q, begin, doc, impact, joint
        self.at = np.full(len(q.vocabulary), -1)
        self.at[terms] = np.arange(len(terms))
        self.u = np.zeros(len(q.vocabulary), np.int64)
        if len(terms):
            self.u[terms] = np.maximum.reduceat(impact, begin[:-1])

    def list_of(self, term: int) -> slice:
        i = self.at[term]
        return slice(self.begin[i], self.begin[i + 1])

    def joint_maxima(self, docs: int) -> np.ndarray:
        """For each chosen pair the largest sum of both impacts in one document; 0 where the lists share none."""
        out, scratch, pairs = np.zeros(len(self.q.pairs), np.int64), np.full(docs, -1, np.int64), self.q.pairs
        present = (self.at[pairs[:, 0]] >= 0) & (self.at[pairs[:, 1]] >= 0) if len(pairs) else np.zeros(0, bool)
        which = np.flatnonzero(present)
        which = which[np.argsort(pairs[which, 0], kind="stable")]
        before = None
        for i in which.tolist():
            a, b = pairs[i]
            if a != before:
                scratch.fill(-1)
                own = self.list_of(a)
                scratch[self.doc[own]] = self.impact[own]
                before = a
            other = self.list_of(b)
            met = scratch[self.doc[other]]
            both = met >= 0
            if both.any():
                out[i] = (met + self.impact[other])[both].max()
        return out

    def bounds(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """The item's terms of this block from the lightest on, and what the first k of them can add at most, for every k."""
        terms = self.q.terms[item]
        terms = terms[self.at[terms] >= 0]
        terms = terms[np.argsort(self.u[terms], kind="stable")]
        u = self.u[terms]
        own = self.q.own[item]
        total = np.concatenate(([0], np.cumsum(u)))
        if not len(own) or len(terms) < 2:
            return terms, total
        place = {t: k for k, t in enumerate(terms.tolist())}
        saving = []
        for i in own.tolist():
            a, b = place.get(self.q.pairs[i, 0]), place.get(self.q.pairs[i, 1])
            if a is not None and b is not None:
                less = u[a] + u[b] - max(self.joint[i], u[a], u[b])
                if less > 0:
                    saving.append((-less, a, b))
        used = set()
        for less, a, b in sorted(saving):  # a matching: each term is in one pair at most
            if a not in used and b not in used:
                used |= {a, b}
                total[max(a, b) + 1 :] += less
        return terms, total

    def search(self, item: int, docs: int, theta: int, bounds=None) -> tuple[np.ndarray, np.ndarray]:
        """Documents with a score of at least ``theta`` and above 0, and the scores."""
        terms, most = bounds or self.bounds(item)
        if most[-1] < max(theta, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        light = int(np.searchsorted(np.maximum.accumulate(most), max(theta, 1), "left")) - 1  # the first ``light`` terms cannot reach it together
        score = np.zeros(docs, np.int64)
        for t in terms[light:].tolist():
            own = self.list_of(t)
            score[self.doc[own]] += self.impact[own]
        found = np.flatnonzero(score)
        for k in range(light - 1, -1, -1):
            found = found[score[found] + most[k + 1] >= theta]
            if not len(found):
                return found, found
            own = self.list_of(terms[k])
            doc = self.doc[own]
            if len(found) * 8 < len(doc):
                at = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
                score[found] += np.where(doc[at] == found, self.impact[own][at], 0)
            else:
                score[doc] += self.impact[own]
        found = found[score[found] >= max(theta, 1)]
        return found, score[found]


def _index(batches, q: Queries):
    for batch in batches:
        for r in range(batch.num_rows):
            terms, begin, doc, tf, n = (_numbers(batch, c, r) for c in ("terms", "begin", "doc", "tf", "n"))
            impact = q.impacts(np.repeat(terms, np.diff(begin)), tf, n[doc])
            block = Block(q, terms, begin, doc, impact)
            block.joint = block.joint_maxima(len(n))
            bound = np.array([block.bounds(i)[1][-1] for i in range(len(q.ids))], np.int64)
            yield pa.RecordBatch.from_pylist([{
                "block": batch.column("block")[r].as_py(), "doc_id": batch.column("doc_id")[r].as_py(), "terms": terms, "begin": begin, "doc": doc,
                "impact": impact, "joint": block.joint, "bound": bound,
            }], _arrow(_INDEX))


def _loaded(batch, r: int, q: Queries) -> tuple[Block, np.ndarray]:
    """A block of the index, and its doc_ids with the largest number for null."""
    ids = batch.column("doc_id")[r].values.fill_null(_LAST).to_numpy(zero_copy_only=False)
    return Block(q, *(_numbers(batch, c, r) for c in ("terms", "begin", "doc", "impact", "joint"))), ids


def _thresholds(batches, q: Queries, asked: dict, top: int):
    for batch in batches:
        out = []
        for r in range(batch.num_rows):
            block, ids = _loaded(batch, r, q)
            for item in asked[batch.column("block")[r].as_py()]:
                score = np.sort(block.search(item, len(ids), 0)[1])
                if len(score) >= top:
                    out.append({"item": item, "theta": int(score[-top])})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("item", pa.int64()), ("theta", pa.int64())]))


def _search(batches, q: Queries, top: int):
    theta = q.theta.copy()
    best: list[list] = [[] for _ in q.ids]
    for batch in batches:
        for r in range(batch.num_rows):
            block, ids = _loaded(batch, r, q)
            for item in np.flatnonzero(_numbers(batch, "bound", r) >= np.maximum(theta, 1)).tolist():
                found, score = block.search(item, len(ids), int(theta[item]))
                if len(found):
                    best[item] = sorted(best[item] + list(zip((-score).tolist(), ids[found].tolist(), strict=True)))[:top]
                    if len(best[item]) == top:
                        theta[item] = max(theta[item], -best[item][-1][0])
    rows = [{"item_id": q.ids[i], "doc_id": None if d == _LAST else d, "score": -s} for i, own in enumerate(best) for s, d in own]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))


def _ranked_slice(docs: DataFrame, q: Queries, top: int) -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(q)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part"))
    blocks = stored(per_batch(rows, lambda b: _postings(b, sent.value), _BLOCK), "postings")
    N, L = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    size = F.transform(F.sequence(F.lit(1), F.size("terms")), lambda i: F.get("begin", i) - F.get("begin", i - 1))
    df = blocks.where(F.size("terms") > 0).select(F.explode(F.arrays_zip("terms", size.alias("n"))).alias("x")).groupBy("x.terms").agg(F.sum("x.n").alias("df")).toArrow()
    count = np.zeros(len(q.vocabulary), np.int64)
    count[df.column("terms").to_numpy()] = df.column("df").to_numpy()
    q.weigh(count, N, L)
    weighed = spark.sparkContext.broadcast(q)
    index = stored(per_batch(blocks.drop("docs", "words"), lambda b: _index(b, weighed.value), _INDEX), "index")
    best = index.select("block", F.posexplode("bound").alias("item", "b")).where("b > 0").groupBy("item").agg(F.max_by("block", F.struct("b", "block")).alias("block"))
    asked: dict[int, list[int]] = {}
    for item, block in best.collect():  # one row for each item of the slice
        asked.setdefault(block, []).append(item)
    first = per_batch(index.where(F.col("block").isin(list(asked))), lambda b: _thresholds(b, weighed.value, asked, top), "item long, theta long") if asked else None
    for item, theta in first.collect() if first is not None else []:
        q.theta[item] = theta
    last = spark.sparkContext.broadcast(q)
    return per_batch(index, lambda b: _search(b, last.value, top), "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents (doc_id, text) of each item (item_id, text)."""
    with passing(docs.sparkSession) as keep:
        out = None
        for q in slices(items):
            found = stored(_ranked_slice(docs, q, top), "found")
            out = found if out is None else out.union(found)
        rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
        return keep(out.withColumn("rank", rank).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score"), "best")


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS t FROM documents),
tot AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_words FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
p AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), tot),
i AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_words)))) AS impact FROM p JOIN w USING (term), tot),
s AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY ALL HAVING sum(impact) > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM s
QUALIFY rank <= {TOP}"""
