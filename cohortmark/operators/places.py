"""Places of texts at which one of a set of words stands, for sets that are small enough to be sent to all tasks.

A row for each place of a text, made only to be dropped by a join, costs about a microsecond. Here a batch of texts is one array of letters: the word at every place is
hashed at once, in as many passes as its length has binary digits, and looked up in a table of bits; only places that are found become rows. Equal words have equal
hashes, so none is lost; what a hash finds too much, the join that follows drops, as it compares words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import ship

#: Letters that a task hashes at once.
AT_ONCE = 250_000
ODD, BASE = np.uint64(0x9E3779B97F4A7C15), 0xBF58476D1CE4E5B9
#: Longest words that are counted by numbers of their letters.
COUNTED = 12


def points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts, one after the other, as numbers, and where each text begins and the last ends. Nulls are empty."""
    texts = texts.fill_null("")
    begin = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(begin) or begin[-1] == begin[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[begin[0] : begin[-1]]
    begin = begin - begin[0]
    if raw.max() < 128:
        return raw, begin
    letters = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32), letters[begin]


def hashed(c: np.ndarray, k: int) -> np.ndarray:
    """For each place a hash of the ``k`` letters from there."""
    n = len(c) - k + 1
    if n < 1 or k < 1:
        return np.zeros(0, np.uint64)
    part, size, out, done, power = c.astype(np.uint64) + np.uint64(1), 1, None, 0, BASE
    while True:
        if k & size:
            own = part[done : done + n]
            out = own.copy() if out is None else out * np.uint64(power) + own
            done += size
        if size * 2 > k:
            return out
        part = part[:-size] * np.uint64(power) + part[size:]
        size, power = 2 * size, power * power % (1 << 64)


class Known:
    """A set of hashes, sorted, and bits that tell most others from them."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.shift = np.uint64(64 - min(max(16, int(len(self.hashes)).bit_length() + 4), 25))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[(self.hashes * ODD) >> self.shift] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``h`` are in the set, and which members they are."""
        i = np.flatnonzero(self.table[(h * ODD) >> self.shift])
        at = np.minimum(np.searchsorted(self.hashes, h[i]), max(len(self.hashes) - 1, 0))
        same = self.hashes[at] == h[i] if len(self.hashes) else np.zeros(0, bool)
        return i[same], at[same]


def slices(batch: pa.RecordBatch, column: str = "seq"):
    """The batch in runs of rows of about ``AT_ONCE`` letters."""
    if not batch.num_rows:
        return
    total = np.cumsum(points(batch.column(column))[1][1:] - points(batch.column(column))[1][:-1])
    edges = np.unique(np.searchsorted(total, np.arange(AT_ONCE, total[-1] + AT_ONCE, AT_ONCE)) + 1)
    start = 0
    for end in [*edges[edges < batch.num_rows].tolist(), batch.num_rows]:
        yield batch.slice(start, end - start)
        start = end


def few(words: DataFrame, most: int) -> dict[int, np.ndarray] | None:
    """Hashes of the words (the only column) by their length; None if there are more than ``most``."""
    found = words.limit(most + 1).toArrow().column(0).combine_chunks()
    if len(found) > most:
        return None
    c, begin = points(found)
    size, out = np.diff(begin), {}
    for k in np.unique(size[size > 0]).tolist():
        out[k] = hashed(c[(begin[:-1][size == k][:, None] + np.arange(k)).reshape(-1)], k)[::k]
    return out


def standing(rows: DataFrame, words: dict[int, np.ndarray], before: int = 0, after: int = 0, other: str | None = None) -> DataFrame:
    """(name, seq_id, start, p, seq, k): each place among the own letters of ``pieces`` at which a word of ``few`` may stand, with the letters around it: up to
    ``before`` before and ``after`` after the word, which is the ``k`` letters from ``p`` (from 0); ``start`` is the place in the record of the first of them.
    With ``other``, letters that are not among A, C, G and T count as this one in words."""
    spark = rows.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(words)
    table = None
    if other is not None:
        table = np.full(256, ord(other), np.uint8)
        table[list(b"ACGT")] = list(b"ACGT")

    def step(batches):
        known = {k: Known(h) for k, h in sent.value.items()}
        for whole in batches:
            for batch in slices(whole):
                c, begin = points(batch.column("seq"))
                if not len(c):
                    continue
                lead, own, offset = (batch.column(x).to_numpy() for x in ("lead", "own", "offset"))
                shown = c if table is None else table[np.minimum(c, 255)]
                parts = []
                for k, have in known.items():
                    i, _ = have.find(hashed(shown, k))
                    row = np.searchsorted(begin, i, "right") - 1
                    p = i - begin[row]
                    ok = (p >= lead[row]) & (p < lead[row] + own[row]) & (i + k <= begin[row + 1])
                    parts.append((i[ok], row[ok], np.full(int(ok.sum()), k)))
                i, row, k = (np.concatenate(x) for x in zip(*parts, strict=True))
                if not len(i):
                    continue
                a, b = np.maximum(i - before, begin[row]), np.minimum(i + k + after, begin[row + 1])
                text = c.astype(np.uint32).tobytes().decode("utf-32-le") if c.dtype != np.uint8 else c.tobytes().decode("ascii")
                seqs = pa.array([text[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.string())
                start = offset[row] - lead[row] + a - begin[row]
                at = pa.array(row)
                cols = [batch.column("name").take(at), batch.column("seq_id").take(at), pa.array(start.astype(np.int32)), pa.array((i - a).astype(np.int32)), seqs, pa.array(k.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["name", "seq_id", "start", "p", "seq", "k"])

    rows = rows.select("name", "seq_id", "offset", "lead", "own", "seq").where("seq <> ''")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(step, f"name {kinds['name']}, seq_id {kinds['seq_id']}, start int, p int, seq string, k int")


def counted(rows: DataFrame, k: int) -> DataFrame:
    """(kmer, n): words of ``k`` letters, up to ``COUNTED``, without N that begin among the own letters of ``pieces``, with how often each batch has them."""
    ship(rows.sparkSession)

    def step(batches):
        for whole in batches:
            for batch in slices(whole):
                c, begin = points(batch.column("seq"))
                if len(c) < k:
                    continue
                lead, own = (batch.column(x).to_numpy().astype(np.int64) for x in ("lead", "own"))
                letters, code = np.unique(c, return_inverse=True) if c.dtype != np.uint8 else (np.flatnonzero(np.bincount(c, minlength=256)), None)
                if code is None:
                    place = np.zeros(256, np.int64)
                    place[letters] = np.arange(len(letters))
                    code = place[c]
                base, n = len(letters), len(c) - k + 1
                number, clear = np.zeros(n, np.int64), np.concatenate(([0], np.cumsum(c == ord("N"))))
                for j in range(k):
                    number = number * base + code[j : j + n]
                # +1 where the places begin that are a piece's own and leave the word within it, -1 where they end
                first, last = begin[:-1] + lead, np.minimum(begin[:-1] + lead + own, begin[1:] - k + 1)
                ok = first < last
                marks = np.bincount(first[ok], minlength=len(c) + 1) - np.bincount(last[ok], minlength=len(c) + 1)
                number = number[(np.cumsum(marks)[:n] > 0) & (clear[k:] == clear[:-k])]
                if base**k <= 1 << 22:
                    times = np.bincount(number)
                    seen = np.flatnonzero(times)
                    times = times[seen]
                else:
                    seen, times = np.unique(number, return_counts=True)
                spelled, rest = np.zeros((len(seen), k), np.uint32), seen.copy()
                for j in range(k - 1, -1, -1):
                    rest, at = np.divmod(rest, base)
                    spelled[:, j] = letters[at]
                text = spelled.tobytes().decode("utf-32-le")
                words = [text[x : x + k] for x in range(0, len(text), k)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(times.astype(np.int64))], names=["kmer", "n"])

    return rows.select("lead", "own", "seq").where("seq <> ''").mapInArrow(step, "kmer string, n long")
