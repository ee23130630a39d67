"""Quality rules with n-gram perplexity bands.

Base rules over the words ``[^\\x20\\x09-\\x0D]+`` of the whole text: too few words, too many words in repeated three-word windows.
Then a modified Kneser-Ney model of each language over characters, counted by Spark over all texts and kept in sorted hash arrays,
gives every text its mean negative log-probability (log-perplexity); documents outside the band of their language,
below or above, are rejected.

A model has 64 character classes (letters by themselves, digits, marks, upper case and UTF-8 bytes in groups) and n-grams of five.
Nothing is pruned: its size follows the different n-grams of the corpus. What a task holds does not: n-grams are dealt into
slices by language and their last two classes, the largest of these cells first, each to the smallest slice so far. A slice has all that scoring its n-grams asks for
(the weight of a context is in every slice that has n-grams which end it); slices are sent one after another, each scores its part of all texts, and the parts add up.
Most corpora need one slice (``SLICE_KEYS``). Languages are told apart by 16 bits of a hash; two that share them would share a model.

Nulls count as empty texts: no words, base_failed. Texts too short for one n-gram have no perplexity and are left to the
base rules. A null language is a language of its own. The model counts each different text of a language once. Bands come from the different texts of a language, so
copies neither move nor narrow them, and are never narrower than the spread of all languages together; the only text of a language is its own median and stays.
Medians are taken on a fine grid, so reruns agree however the rows are dealt. Very long texts are a step of their own. Extra columns are ignored. On an empty table the result is empty.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytescan as B
from .runtime import BROADCAST_IDS, cut, join_skewed, passing, per_batch, small_enough, text_steps

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ORDER, BITS = 5, 6
#: Half-widths of the band in scaled median absolute deviations of the language, for a text of the given length: the mean over n
#: characters spreads as 1 / sqrt(n). At least LEAST nats a character.
LOWER, UPPER, LEAST = 5.0, 5.0, 0.03
#: n-grams of all orders in a slice, about 20 bytes each.
SLICE_KEYS = 4_000_000
#: Text bytes measured at once: the arrays of a step take about 60 times as much.
MEASURED_BYTES = 1 << 18
#: n-grams that a counting task holds before it passes them on.
HELD_KEYS = 2_000_000

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def classes() -> np.ndarray:
    """Byte -> one of 64 classes."""
    out = np.full(256, 34, np.uint8)  # other marks and controls
    out[ord("a") : ord("z") + 1] = np.arange(26)
    out[ord("A") : ord("Z") + 1] = 26
    out[ord("0") : ord("9") + 1] = 27
    for i, chars in enumerate((" \t\v\f\r", "\n", ".", ",", "'\"()-:;?!", "#*$%&|<>")):
        out[[ord(c) for c in chars]] = 28 + i
    out[0x80:0xC0] = 35 + (np.arange(64) & 15)  # continuation bytes
    out[0xC0:0x100] = 51 + np.minimum(np.arange(64) // 5, 12)  # lead bytes
    return out


CLASS = classes()


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each five classes of one row, and the row."""
    c = CLASS[data].astype(np.int64)
    n = len(c) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.zeros(n, np.int64)
    for j in range(ORDER):
        key = key << BITS | c[j : j + n]
    size = np.maximum(np.diff(off) - ORDER + 1, 0)
    row = np.repeat(np.arange(len(size)), size)
    at = np.repeat(off[:-1] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(len(row))
    return key[at], row


def with_tongue(tongue: np.ndarray, key: np.ndarray, order: int) -> np.ndarray:
    return tongue << BITS * order | key


def counted(batches):
    """(tongue, key, n): n-gram counts of a task, merged as it goes."""
    mask = (1 << BITS * ORDER) - 1

    def out(keys, counts):
        for i in range(0, len(keys), 1 << 16):
            k, n = keys[i : i + (1 << 16)], counts[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array((k >> BITS * ORDER).astype(np.int32)), pa.array(k & mask), pa.array(n)], names=["tongue", "key", "n"])

    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for i, j, data, off in text_steps(batch.column("text")):
            tongue = batch.column("tongue").slice(i, j - i).to_numpy().astype(np.int64)
            key, row = grams(data, off)
            k, n = np.unique(with_tongue(tongue[row], key, ORDER), return_counts=True)
            k, back = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(k)).astype(np.int64)
            keys = k
            if len(keys) > HELD_KEYS:
                yield from out(keys, counts)
                keys, counts = keys[:0], counts[:0]
    yield from out(keys, counts)


def discounted(counts: DataFrame) -> DataFrame:
    """``counts`` (tongue, key, n) with ``off``: D1, D2 or D3+ of modified Kneser-Ney from the language's counts of counts."""
    some = [F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    by = counts.groupBy(F.col("tongue").alias("t")).agg(*some)  # at most 2**16 rows
    y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    for k, most in ((1, 0.95), (2, 1.9), (3, 2.85)):
        a, b = F.col(f"n{k}"), F.col(f"n{k + 1}")
        by = by.withColumn(f"d{k}", F.when(a > 0, F.least(F.greatest(k - (k + 1) * y * b / a, F.lit(0.05)), F.lit(most))).otherwise(most))
    off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = counts.join(F.broadcast(by.select("t", "d1", "d2", "d3")), F.col("tongue") == F.col("t"))
    return rows.select("tongue", "key", "n", F.least(off, F.col("n") * 0.999).alias("off"))


@dataclass
class Deal:
    """Which slice the n-grams of a cell, a language with their last two classes, go to. ``heads`` holds the slice of unseen cells, by language and last class but one."""

    slices: int
    cells: np.ndarray
    slice_of: np.ndarray
    heads: np.ndarray
    head_slice: np.ndarray

    def __call__(self, tongue: np.ndarray, keys: np.ndarray) -> np.ndarray:
        cell = tongue << 2 * BITS | keys & (1 << 2 * BITS) - 1
        out = found(self.heads, cell >> BITS, self.head_slice, 0)
        return found(self.cells, cell, self.slice_of, out)


def found(table: np.ndarray, keys: np.ndarray, values: np.ndarray, other) -> np.ndarray:
    """``values`` at the places of ``keys`` in the sorted ``table``, else ``other``."""
    if not len(table):
        return np.broadcast_to(other, keys.shape).copy()
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], other)


def cell_column() -> F.Column:
    return F.shiftleft(F.col("tongue").cast("long"), 2 * BITS).bitwiseOR(F.col("key").bitwiseAND(F.lit((1 << 2 * BITS) - 1)))


def deal(tables: list[DataFrame], slices: int) -> Deal:
    """The largest cells first, each to the smallest slice: at most 4096 cells a language come to the driver."""
    every = None
    for rows in tables[1:]:
        own = rows.groupBy(cell_column().alias("cell")).agg(F.count("*").alias("n"))
        every = own if every is None else every.union(own)
    got = every.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = got.column("cell").to_numpy(), got.column("n").to_numpy()
    order = np.lexsort((cell, -n))
    heap, slice_of = [(0, i) for i in range(slices)], np.zeros(len(cell), np.int64)
    for i in order.tolist():
        size, k = heapq.heappop(heap)
        slice_of[i] = k
        heapq.heappush(heap, (size + int(n[i]), k))
    heads, first = np.unique(cell[order] >> BITS, return_index=True)
    at = np.argsort(cell)
    return Deal(slices, cell[at], slice_of[at], heads, slice_of[order][first])


class Model:
    """A slice of all languages' models: by order the sorted keys and log-probabilities, the sorted contexts and their backoff weights."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], part: int = 0, how: Deal | None = None):
        self.tables, self.part, self.how = tables, part, how

    def logp(self, tongue: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Log-probability of the last class of each n-gram of this slice; 0 for others."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        if self.how:
            left = left[self.how(tongue, keys) == self.part]
        for order in range(ORDER, 0, -1):
            grams_, logp, contexts, weight = self.tables[order - 1]
            if not len(left):
                return out
            k = with_tongue(tongue[left], keys[left] & (1 << BITS * order) - 1, order)
            at = np.minimum(np.searchsorted(grams_, k), max(len(grams_) - 1, 0))
            hit = grams_[at] == k if len(grams_) else np.zeros(len(k), bool)
            out[left[hit]] += logp[at[hit]]
            left, k = left[~hit], k[~hit]
            if len(left) and len(contexts):
                c = k >> BITS
                at = np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
                out[left] += np.where(contexts[at] == c, weight[at], 0.0)
        out[left] -= BITS * np.log(2)  # never seen: uniform over the classes
        return out


def one_each(batches):
    """The first row of each text_hash and language of a task."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        first = []
        for i, h in enumerate(zip(batch.column("text_hash").to_pylist(), batch.column("tongue").to_pylist(), strict=True)):
            if h not in seen:
                seen.add(h)
                first.append(i)
        if first:
            yield batch.take(pa.array(first, pa.int64()))


def taught(docs: DataFrame) -> DataFrame:
    """The texts that the model counts: each different one of a language once. Only texts that have copies are exchanged, and of these one for each task."""
    rows = docs.select("text_hash", "tongue", "text")
    many = cut(rows.groupBy("text_hash").agg(F.count("*").alias("n")).where("n > 1").select("text_hash"))
    if many.isEmpty():
        return rows.select("tongue", "text")
    many = F.broadcast(many) if small_enough(many, BROADCAST_IDS) else many
    once = per_batch(rows.join(many, "text_hash", "left_semi"), one_each, "text_hash long, tongue int, text string").dropDuplicates(["text_hash", "tongue"])
    return rows.join(many, "text_hash", "left_anti").select("tongue", "text").union(once.select("tongue", "text"))


def model(docs: DataFrame) -> list[DataFrame]:
    """By order, (tongue, key, p, context, weight): the probability of each n-gram and the backoff weight of its context."""
    top = per_batch(taught(docs), counted, "tongue int, key long, n long").groupBy("tongue", "key").agg(F.sum("n").alias("n"))
    counts = {ORDER: cut(top)}
    low_bits = lambda n: F.col("key").bitwiseAND(F.lit((1 << BITS * n) - 1))
    for order in range(ORDER - 1, 0, -1):  # continuation counts: how many different classes stand before
        counts[order] = cut(counts[order + 1].groupBy("tongue", low_bits(order).alias("key")).agg(F.count("*").alias("n")))
    tables, lower = [], None
    for order in range(1, ORDER + 1):
        rows = discounted(counts[order]).withColumn("context", F.shiftright("key", BITS))
        total = rows.groupBy("tongue", "context").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("weight"))
        rows = rows.join(total, ["tongue", "context"])
        if lower is None:
            p = rows.withColumn("low", F.lit(1.0 / (1 << BITS)))
        else:
            p = rows.withColumn("suffix", low_bits(order - 1)).join(lower, ["tongue", "suffix"])
        p = p.select("tongue", "key", "context", "weight", ((F.col("n") - F.col("off")) / F.col("total") + F.col("weight") * F.col("low")).alias("p"))
        tables.append(cut(p))
        lower = tables[-1].select("tongue", F.col("key").alias("suffix"), F.col("p").alias("low"))
    return tables


def sent(tables: list[DataFrame], part: int, how: Deal | None) -> Model:
    """One slice, as arrays. Single classes and the empty context belong to every slice."""
    arrays = []
    for order, rows in enumerate(tables, 1):
        own, around = rows, rows
        if how and order > 1:
            spark, mine = rows.sparkSession, how.cells[how.slice_of == part]
            heads = np.union1d(mine >> BITS, how.heads[how.head_slice == part])
            column = lambda a: F.broadcast(spark.createDataFrame(pa.table({"__c": pa.array(a, pa.int64())})))  # noqa: E731  (at most 4096 a language)
            own = rows.join(column(mine), cell_column() == F.col("__c"), "left_semi")
            around = rows.join(column(heads), F.shiftright(cell_column(), BITS) == F.col("__c"), "left_semi")
        got = own.select("tongue", "key", "p").toArrow()
        contexts = around.select("tongue", "context", "weight").distinct().toArrow()
        pair = []
        for table, name, value, n in ((got, "key", "p", order), (contexts, "context", "weight", order - 1)):
            key = with_tongue(table.column("tongue").to_numpy().astype(np.int64), table.column(name).to_numpy(), n)
            at = np.argsort(key)
            pair += [key[at], np.log(np.maximum(table.column(value).to_numpy()[at], 1e-12)).astype(np.float32)]
        arrays.append(tuple(pair))
    return Model(arrays, part, how)


def totals(scorer: Model | None, keys: np.ndarray, row: np.ndarray, tongue: np.ndarray) -> np.ndarray:
    """Sum of log-probabilities of each row."""
    n = len(tongue)
    return np.bincount(row, scorer.logp(tongue[row], keys), n) if scorer and len(keys) else np.zeros(n)


def scored(batches, scorer: Model):
    """(row_key, total) of the texts under one slice."""
    for batch in batches:
        for i, j, data, off in text_steps(batch.column("text"), MEASURED_BYTES):
            tongue = batch.column("tongue").slice(i, j - i).to_numpy().astype(np.int64)
            total = totals(scorer, *grams(data, off), tongue)
            yield pa.RecordBatch.from_arrays([batch.column("row_key").slice(i, j - i), pa.array(total)], names=["row_key", "total"])


def measured(batches, scorer):
    """Base measures of each row, and its log-probability under one slice."""
    for batch in batches:
        for i, j, data, off in text_steps(batch.column("text"), MEASURED_BYTES):
            n = j - i
            first, last, row = B.words(data, off)
            n_words = np.bincount(row, minlength=n)
            inside = ~B.SPACE[data] & ~B.CONTINUATION[data]
            at = np.concatenate(([0], np.cumsum(inside)))
            chars = at[off[1:]] - at[off[:-1]]
            at = np.concatenate(([0], np.cumsum(SYMBOL[data])))
            symbols = at[off[1:]] - at[off[:-1]]
            # lines: cut at each \n and at each row
            h = B.span_hashes(data, first, last)
            breaks = np.flatnonzero(data == 10)
            cuts = np.union1d(off[:-1], breaks + 1)
            cuts = cuts[cuts < len(data)]
            line_row = np.searchsorted(off, cuts, "right") - 1
            ends = np.append(cuts[1:], len(data)) - 1
            ends = np.where((ends >= cuts) & (data[np.maximum(ends, 0)] == 10), ends - 1, ends)
            full = np.zeros(len(cuts), bool)
            full[np.searchsorted(cuts, first, "right") - 1] = True
            cuts, ends, line_row = cuts[full], ends[full], line_row[full]
            lines = B.span_hashes(data, cuts, ends)
            dup_lines = np.bincount(line_row[repeats(lines, line_row, later=True)], minlength=n)
            # words in windows that stand twice or more
            w, start = B.window_hashes(h, row, 3)
            start = start[repeats(w, row[start], later=False)]
            covered = np.zeros(len(row), bool)
            for k in range(3):
                covered[start + k] = True
            repeat_words = np.bincount(row[covered], minlength=n)
            keys, key_row = grams(data, off)
            size = np.bincount(key_row, minlength=n)
            tongue = batch.column("tongue").slice(i, n).to_numpy().astype(np.int64)
            total = totals(scorer, keys, key_row, tongue)
            cols = [pa.array(c.astype(np.int64)) for c in (n_words, chars, symbols, dup_lines, repeat_words, size)]
            own = ["doc_id", "lang", "text_hash", "row_key"]
            names = [*own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "total"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, n) for c in own), *cols, pa.array(total)], names=names)


def repeats(h: np.ndarray, row: np.ndarray, later: bool) -> np.ndarray:
    """Indexes of hashes found twice or more in their row: those after the first, or all."""
    order = np.lexsort((h, row))
    same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
    mask = np.zeros(len(h), bool)
    mask[1:] |= same
    if not later:
        mask[:-1] |= same
    return order[mask]


SCHEMA = (
    "doc_id long, lang string, text_hash long, row_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_grams long, total double"
)


def medians(rows: DataFrame, value: F.Column, step: float, by: str | None = None) -> DataFrame:
    """The median of ``value`` on a grid of width ``step``, and the number of rows ``n``, for each ``by`` (or of all rows)."""
    key = F.lit(0) if by is None else F.col(by)
    cells = rows.groupBy(key.alias("by"), F.floor(value / step).alias("cell")).agg(F.count("*").alias("k"))
    every = Window.partitionBy("by")
    up = every.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.select("by", "cell", F.sum("k").over(up).alias("to"), F.sum("k").over(every).alias("n")).where("2 * to >= n")
    return cells.groupBy("by").agg(((F.min("cell") + 0.5) * step).alias("median"), F.max("n").alias("n"))


def measures(docs: DataFrame, slice_keys: int) -> DataFrame:
    """SCHEMA's columns for each row, ``total`` over all slices."""
    spark = docs.sparkSession
    tables = model(docs)
    size = sum(t.count() for t in tables)
    slices = max(1, -(-size // slice_keys))
    how = deal(tables, slices) if slices > 1 else None
    rows, more = None, []
    for part in range(slices):
        scorer = spark.sparkContext.broadcast(sent(tables, part, how))
        if rows is None:
            rows = cut(per_batch(docs, lambda it, s=scorer: measured(it, s.value), SCHEMA))
        else:  # repeated rows share a key and a total
            own = per_batch(docs.select("row_key", "tongue", "text"), lambda it, s=scorer: scored(it, s.value), "row_key long, total double")
            more.append(cut(own.groupBy("row_key").agg(F.max("total").alias("more"))))
        scorer.destroy()
    for own in more:
        rows = join_skewed(rows, own, "row_key").withColumn("total", F.col("total") + F.col("more")).drop("more")
    return rows


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text, and what tells texts, rows and languages apart."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text")).withColumn("row_key", F.xxhash64("doc_id", "lang", "text"))
    return docs.withColumn("tongue", F.pmod(F.xxhash64("lang"), F.lit(1 << 16)).cast("int"))


def quality(docs: DataFrame, lower: float = LOWER, upper: float = UPPER, least: float = LEAST, slice_keys: int = SLICE_KEYS) -> DataFrame:
    """Measures, base_failed and kept of each row of ``docs`` (doc_id, text, lang)."""
    docs = prepared(docs)
    with passing(docs.sparkSession) as keep:
        rows = measures(docs, slice_keys)
        failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
        rows = rows.withColumn("base_failed", failed).withColumn("log_perplexity", F.when(F.col("n_grams") > 0, -F.col("total") / F.col("n_grams")))
        rows = keep(rows, "quality")
        # One value for each different text of a language, however often it stands.
        good = rows.where("not base_failed and log_perplexity is not null").groupBy("lang", "text_hash")
        good = cut(good.agg(F.max("log_perplexity").alias("lp"), F.max("n_grams").alias("n_grams")))
        middle = medians(good, F.col("lp"), 1e-4, "lang").select(F.col("by").alias("l"), F.col("median").alias("mid"))
        spread = good.join(middle, F.col("lang").eqNullSafe(F.col("l")))
        dev = F.abs(F.col("lp") - F.col("mid")) * F.sqrt("n_grams")
        pooled = medians(spread, dev, 1e-2).first()
        mad = F.greatest(F.col("median"), F.lit(pooled["median"] if pooled else 0.0)) * 1.4826
        bands = medians(spread, dev, 1e-2, "lang").select(F.col("by").alias("band_lang"), mad.alias("mad"))
        bands = keep(bands.join(middle, F.col("band_lang").eqNullSafe(F.col("l"))).select("band_lang", "mid", "mad"), "bands")
    out = rows.join(bands, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
    width = lambda k: F.greatest(F.col("mad") * k / F.sqrt(F.greatest("n_grams", F.lit(1))), F.lit(least))
    out = out.withColumn("ppl_low", F.col("mid") - width(lower)).withColumn("ppl_high", F.col("mid") + width(upper))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("ppl_low"), F.col("ppl_high")), F.lit(True))
    out = out.withColumn("kept", ~F.col("base_failed") & inside)
    return out.drop("lang", "text_hash", "row_key", "total", "band_lang", "mid", "mad")
