"""Search with degenerate oligos: ambiguity codes as sets of bases.

A text letter matches an oligo letter if every base that it may be is one that the oligo allows: R in an oligo matches A, G and R, N matches all. An oligo with m allowed
mismatches is cut into m + 1 pieces, one of which must match in full. A piece is written out as the words of text letters that it matches; one that stands for more than
EXPAND words gives way to the longest part of it that does not. Candidates are compared a base at a time for all places at once: four bit masks of each side, of which
the text's must lie within the oligo's. Where the words are few enough to be sent to all tasks, both are done for a batch of texts at once (``matched``), and only places
that match become rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmark.functions.sequence import reverse_complement

from . import places
from .search import CHUNK, LARGE, SENT_WORDS
from .sequences import pieces, sized
from .storage import ship

#: Ambiguity codes and the bases that they stand for.
SETS = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
LETTERS = "".join(SETS)
#: Most words that a piece of an oligo is written out as.
EXPAND = 256
#: Places of one bit mask.
BITS = 60
#: Places of one number of four bits each, and candidates that a task compares at once.
NIBBLES, AT_ONCE = 16, 1_000_000


def clean(seq: Column) -> Column:
    """Upper case, T for U, N for letters that are no codes."""
    return F.regexp_replace(F.translate(F.upper(seq), "U", "T"), f"[^{LETTERS}]", "N")


def _bits(seq: Column, base: str) -> Column:
    """A number with a bit for each place, the first place highest: whether the letter may be ``base``."""
    flags = "".join(str(int(base in SETS[x])) for x in LETTERS)
    return F.coalesce(F.conv(F.nullif(F.translate(seq, LETTERS, flags), F.lit("")), 2, 10).cast("long"), F.lit(0).cast("long"))


def differing(oligo: Column, site: Column, longest: int) -> Column:
    """Places at which the site may be a base that the oligo does not allow; both clean and of one length."""
    total = F.lit(0)
    for at in range(1, longest + 1, BITS):
        o, s = F.substring(oligo, at, BITS), F.substring(site, at, BITS)
        bad = None
        for b in "ACGT":
            own = _bits(s, b).bitwiseAND(F.bitwise_not(_bits(o, b)))
            bad = own if bad is None else bad.bitwiseOR(own)
        total = total + F.bit_count(bad)
    return total


def _choices() -> Column:
    return F.create_map(*[x for c in LETTERS for x in (F.lit(c), F.array(*[F.lit(t) for t in LETTERS if set(SETS[t]) <= set(SETS[c])]))])


def words(seed: Column) -> Column:
    """All words of text letters that a seed matches."""
    choices = _choices()
    start = F.array(F.lit(""))
    grow = lambda found, c: F.flatten(F.transform(found, lambda w: F.transform(choices[c], lambda x: F.concat(w, x))))
    return F.aggregate(F.filter(F.split(seed, ""), lambda c: c != ""), start, grow)


def n_words(seed: Column) -> Column:
    sizes = F.create_map(*[F.lit(x) for c in LETTERS for x in (c, sum(set(SETS[t]) <= set(SETS[c]) for t in LETTERS))])
    return F.aggregate(F.filter(F.split(seed, ""), lambda c: c != ""), F.lit(1.0), lambda n, c: n * sizes[c])


def seeds(oligos: DataFrame, mismatch: float) -> DataFrame:
    """oligo, strand, oseq, n, m, at, seed: for each piece of an oligo its longest part of at most EXPAND words (ties: the fewest words, then the first)."""
    plus = oligos.select("oligo", F.lit("+").alias("strand"), clean(F.col("seq")).alias("oseq")).where("oseq <> ''")
    both = plus.union(plus.select("oligo", F.lit("-"), reverse_complement(F.col("oseq"))))
    both = both.withColumn("n", F.length("oseq")).withColumn("m", F.floor(F.lit(mismatch) * F.col("n") + 1e-9).cast("int"))
    both = both.withColumn("size", F.floor(F.col("n") / (F.col("m") + 1)).cast("int"))
    parts = both.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m")))).withColumn("from", F.col("i") * F.col("size"))
    parts = parts.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size")))).withColumn("at", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("size") - F.col("k"))))
    parts = parts.withColumn("seed", F.substring(F.col("oseq"), F.col("at") + 1, F.col("k"))).withColumn("words", n_words(F.col("seed"))).where(F.col("words") <= EXPAND)
    best = F.max_by(F.struct("at", "seed"), F.struct("k", -F.col("words"), -F.col("at"))).alias("x")
    return parts.groupBy("oligo", "strand", "oseq", "n", "m", "i").agg(best).select("oligo", "strand", "oseq", "n", "m", "x.*")


def packed(c: np.ndarray) -> np.ndarray:
    """For each of the places ``c``, four bits each, the ``NIBBLES`` places from there as one number."""
    out, size = np.concatenate((c, np.zeros(NIBBLES, c.dtype))).astype(np.uint64), 1
    while size < NIBBLES:
        out = out[:-size] | out[size:] << np.uint64(4 * size)
        size *= 2
    return out[: len(c)]


def matched(asked: pa.Table, texts: DataFrame) -> DataFrame:
    """(name, seq_id, pos, oseq, mismatches): where the oligos of ``asked`` (oseq, m, at, word; one of its words at ``at``) lie in clean texts with at most m places that they
    do not allow. May give a place once for each of its words."""
    bits = np.zeros(256, np.uint8)
    for x, own in SETS.items():
        bits[ord(x)] = sum(1 << "ACGT".index(b) for b in own)
    oligo = asked.column("oseq").combine_chunks().dictionary_encode()
    which, names = oligo.indices.to_numpy(), oligo.dictionary
    at, limit = asked.column("at").to_numpy(), np.zeros(len(names), np.int64)
    limit[which] = asked.column("m").to_numpy()
    c, begin = places.points(names)
    n, longest = np.diff(begin), int(np.diff(begin).max())
    allowed = np.full((len(names), -(-longest // NIBBLES) * NIBBLES), 15, np.uint8)
    allowed[np.repeat(np.arange(len(n)), n), np.arange(len(c)) - np.repeat(begin[:-1], n)] = bits[c]
    allowed = packed(allowed.reshape(-1))[::NIBBLES].reshape(len(names), -1)
    spelled, ends = places.points(asked.column("word").combine_chunks())
    size, seeds = np.diff(ends), {}
    for k in np.unique(size).tolist():
        own = np.flatnonzero(size == k)
        h = places.hashed(spelled[(ends[own][:, None] + np.arange(k)).reshape(-1)], k)[::k]
        order = np.argsort(h, kind="stable")
        _, first = np.unique(h[order], return_index=True)
        seeds[k] = (h, np.append(first, len(h)), which[own][order], at[own][order])
    ship(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast((seeds, allowed, n, limit, names))

    def compared(t, begin, i, row, member, first, which, at, allowed, n, limit):
        count = first[member + 1] - first[member]
        own = np.repeat(np.arange(len(i)), count)
        entry = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[member], count)
        o, start, row = which[entry], i[own] - at[entry], row[own]
        ok = (start >= begin[row]) & (start + n[o] <= begin[row + 1])
        o, start, row = o[ok], start[ok], row[ok]
        bad = np.zeros(len(o), np.int64)
        for w in range(allowed.shape[1]):
            x = t[start + w * NIBBLES] & ~allowed[o, w]
            x |= x >> np.uint64(2)
            x |= x >> np.uint64(1)
            bad += np.bitwise_count(x & np.uint64(0x1111111111111111))
        ok = bad <= limit[o]
        return row[ok], start[ok], o[ok], bad[ok]

    def step(batches):
        seeds, allowed, n, limit, names = sent.value
        known = {k: places.Known(x[0]) for k, x in seeds.items()}
        for whole in batches:
            for batch in places.slices(whole):
                c, begin = places.points(batch.column("seq"))
                lead, own, offset = (batch.column(x).to_numpy() for x in ("lead", "own", "offset"))
                t, parts = packed(np.concatenate((bits[c], np.zeros(allowed.shape[1] * NIBBLES, np.uint8)))), []
                for k, (_, first, which, at) in seeds.items():
                    i, member = known[k].find(places.hashed(c, k))
                    row = np.searchsorted(begin, i, "right") - 1
                    p = i - begin[row]
                    ok = (p >= lead[row]) & (p < lead[row] + own[row]) & (i + k <= begin[row + 1])
                    i, row, member = i[ok], row[ok], member[ok]
                    total = np.cumsum(first[member + 1] - first[member])
                    cuts = np.unique(np.searchsorted(total, np.arange(AT_ONCE, (total[-1] if len(total) else 0) + AT_ONCE, AT_ONCE)) + 1)
                    for x, y in zip([0, *cuts], [*cuts, len(i)], strict=True):
                        if x < y:
                            parts.append(compared(t, begin, i[x:y], row[x:y], member[x:y], first, which, at, allowed, n, limit))
                if not parts:
                    continue
                row, start, o, bad = (np.concatenate(x) for x in zip(*parts, strict=True))
                there = pa.array(row)
                pos = offset[row] - lead[row] + start - begin[row]
                cols = [batch.column("name").take(there), batch.column("seq_id").take(there), pa.array(pos.astype(np.int32)), names.take(pa.array(o)), pa.array(bad.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["name", "seq_id", "pos", "oseq", "mismatches"])

    rows = pieces(texts, longest, longest + max(seeds), max(LARGE, longest), max(LARGE, longest)).select("name", "seq_id", "offset", "lead", "own", "seq").where("seq <> ''")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(step, f"name {kinds['name']}, seq_id {kinds['seq_id']}, pos int, oseq string, mismatches int")


def search(oligos: DataFrame, sequences: DataFrame, mismatch: float = 0.1, sent_words: int = SENT_WORDS) -> DataFrame:
    """(oligo, strand, name, seq_id, pos, n, mismatches): where each oligo (oligo, seq) lies in ``sequences`` (name, seq_id, seq) with at most int(mismatch * length)
    places that it does not allow. Both strands; pos counts from 0 on the forward strand."""
    found, own = None, seeds(oligos, mismatch).withColumn("k", F.length("seed"))
    lengths = sorted(tuple(r) for r in own.groupBy("k").agg(F.max("n")).collect())  # a handful
    texts = sequences.select("name", "seq_id", clean(F.col("seq")).alias("seq"))
    asked = own.select("oseq", "m", "at", F.explode(words(F.col("seed"))).alias("word")).distinct().limit(sent_words + 1).toArrow()
    if 0 < asked.num_rows <= sent_words:
        both = own.select("oligo", "strand", "oseq", "n").distinct()
        return matched(asked, texts).join(sized(both), "oseq").select("oligo", "strand", "name", "seq_id", "pos", "n", "mismatches").distinct()
    for k, longest in lengths:
        rows = pieces(texts, longest, longest + k, CHUNK, LARGE)
        last = F.least(F.col("lead") + F.col("own"), F.length("seq") - k + 1) - 1
        rows = rows.where(last >= F.col("lead")).withColumn("p", F.explode(F.sequence(F.col("lead"), last))).withColumn("word", F.substring(F.col("seq"), F.col("p") + 1, F.lit(k)))
        asked = own.where(F.col("k") == k).withColumn("word", F.explode(words(F.col("seed"))))
        hits = rows.join(sized(asked.drop("seed", "k")), "word").withColumn("first", F.col("p") - F.col("at"))
        hits = hits.where((F.col("first") >= 0) & (F.col("first") + F.col("n") <= F.length("seq")))
        site = F.substring(F.col("seq"), F.col("first") + 1, F.col("n"))
        hits = hits.withColumn("mismatches", differing(F.col("oseq"), site, longest).cast("int")).where("mismatches <= m")
        hits = hits.select("oligo", "strand", "name", "seq_id", (F.col("offset") - F.col("lead") + F.col("first")).alias("pos"), "n", "mismatches")
        found = hits if found is None else found.union(hits)
    if found is None:
        return oligos.select("oligo").limit(0).selectExpr("oligo", "'' strand", "'' name", "'' seq_id", "0 pos", "0 n", "0 mismatches")
    return found.distinct()
