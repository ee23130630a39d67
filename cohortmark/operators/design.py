"""Design of candidate primer pairs by enumeration: every k-mer, filtered, joined by product size, ranked by penalty; with probes between them if asked for.

Everything about a pair lies within ``product_max`` bases, so pairs are found in pieces of the records that overlap by as much: oligos by running sums (``fitting``), pairs by
sizes, whether there is room for a probe by the end of the nearest one. Each piece gives the best pairs of each genome that do not bind each other, with their best probes; only
these become rows. Where the best ones of a piece all bind, the piece itself is a row, and all pairs of such pieces are looked at in a second round, dealt out anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmark.functions.sequence import GAS, STACKS, SYMMETRY, TERMINAL_AT, TERMINAL_GC, reverse_complement

from . import words
from .search import LARGE
from .sequences import pieces
from .storage import ship, stored

#: Letters of pieces that are looked at at once, and pairs.
AT_ONCE, PAIRS = 100_000, 1_000_000


@dataclass(frozen=True)
class Design:
    """Parameters and their defaults. ``max_*`` are the longest runs of complementary bases allowed (None: any): within an oligo and its copies, within a pair, and those
    that the 3' end takes part in."""

    num_return: int = 10
    size_min: int = 18
    size_opt: int = 20
    size_max: int = 22
    wt_lt: float = 1.0
    wt_gt: float = 1.0
    tm_min: float = 58.0
    tm_opt: float = 59.0
    tm_max: float = 60.0
    gc_min: float = 30.0
    gc_opt: float = 55.0
    gc_max: float = 80.0
    product_min: int = 50
    product_opt: int = 100
    product_max: int = 150
    poly_x: int = 3
    probe: bool = False
    probe_size_min: int = 13
    probe_size_opt: int = 20
    probe_size_max: int = 30
    probe_tm_min: float = 68.0
    probe_tm_opt: float = 69.0
    probe_tm_max: float = 70.0
    probe_gc_min: float = 30.0
    probe_gc_opt: float = 55.0
    probe_gc_max: float = 80.0
    nearest_neighbours: bool = False
    salt: float = 0.05
    strands: float = 5e-8
    max_self: int | None = None
    max_self_end: int | None = None
    max_pair: int | None = None
    max_pair_end: int | None = None


def boulder_input(names: DataFrame, design: Design = Design()) -> DataFrame:
    """name, value: the parameters of a design request as key=value lines, one request for each genome. Parameters that are not set are left out, yes and no are 1 and 0."""
    lines = [f"{k.upper()}={int(v) if isinstance(v, bool) else v}" for k, v in asdict(design).items() if v is not None]
    return names.select("name", F.concat_ws("\n", F.concat(F.lit("SEQUENCE_ID="), F.col("name")), *map(F.lit, lines), F.lit("=")).alias("value"))


def bonds(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each two oligos the longest run of bases of the first that pair with neighbouring ones of the second, and the longest that holds the first's 3' end.

    All pairs at once, along each diagonal of the first against the second's reverse complement.
    """
    other = str.maketrans("ACGT", "TGCA")
    n, m = max(map(len, a), default=0), max(map(len, b), default=0)
    # Pairs lie along the last axis, the first oligos end together.
    x = np.frombuffer("".join(p.rjust(n) for p in a).encode(), np.uint8).reshape(len(a), n).T.copy()
    y = np.frombuffer("".join(q[::-1].translate(other).ljust(m) for q in b).encode(), np.uint8).reshape(len(b), m).T.copy()
    x[~np.isin(x, list(b"ACGT"))] = 1
    kind = np.uint8 if max(n, m) < 256 else np.int32
    most, end = np.zeros(len(a), kind), np.zeros(len(a), kind)
    for s in range(1 - m, n):
        run = np.zeros(len(a), kind)
        for i in range(max(0, s), min(n, s + m)):
            run += kind(1)
            run *= x[i] == y[i - s]
            np.maximum(most, run, out=most)
        if s + m >= n:
            np.maximum(end, run, out=end)
    return most.astype(np.int64), end.astype(np.int64)


def apart(a: list[str], b: list[str], most: int | None, end: int | None) -> np.ndarray:
    """Which two oligos have no longer runs of complementary bases than allowed, the 3' ends of both looked at."""
    each: dict[tuple[str, str], int] = {}  # repeats in a text give the same two oligos many times
    at = np.array([each.setdefault(k, len(each)) for k in zip(a, b, strict=True)], np.int64)
    x, y = [k[0] for k in each], [k[1] for k in each]
    keep, (any1, end1) = np.ones(len(x), bool), bonds(x, y)
    if most is not None:
        keep &= any1 <= most
    if end is not None:
        keep &= end1 <= end
        left = np.flatnonzero(keep)
        keep[left] = bonds([y[i] for i in left], [x[i] for i in left])[1] <= end
    return keep[at]


def limits(c: np.ndarray, d: Design, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """What oligos of up to ``high`` bases of a text are decided by: running sums of bases; from each place the distance to the end of the nearest thing behind it that no oligo may
    hold; for each place at which a 3' end may begin, how far before it the nearest word begins that it binds."""
    n, most = len(c), d.poly_x + 1
    # Sums of G and C, and of what is no base as more than any oligo has; they may run over, as only differences are looked at.
    kind, heavy = (np.uint16, 256) if high < 255 else (np.uint32, 1 << 16)
    near = np.uint8 if high < 255 else np.uint16  # distances; its largest number is none
    none = near(np.iinfo(near).max)
    sums = np.zeros(n + 1, kind)
    np.cumsum(np.array([0, 1, 1, 0, heavy], kind)[c], out=sums[1:], dtype=kind)
    same = np.ones(max(n - most + 1, 0), bool)
    for j in range(1, most):
        same &= c[: len(same)] == c[j : j + len(same)]

    def least(steps: int, size: int, alike: Callable) -> np.ndarray:
        """For each of ``size`` places the least of ``steps`` numbers j, for which ``alike(j)`` holds there."""
        out = np.full(size, none, near)
        for j in range(min(steps, size)):
            hit = alike(j)
            own = out[: len(hit)]
            np.minimum(own, hit.astype(near) - near(1) | near(j), out=own)  # none where there is no hit
        return out

    ends = [np.where(same, near(most), none)] if most <= high else []
    if d.max_self is not None and d.max_self < min(high, words.WIDE):
        ahead, back = words.spelled(c, d.max_self + 1)
        m = len(ahead)
        found = least(high - d.max_self, m, lambda j: (ahead[: m - j] == back[j:]) | (back[: m - j] == ahead[j:]))
        ends.append(np.where(found < none, found + near(d.max_self + 1), none))
    place, far = np.arange(n + 1, dtype=np.int32), np.int32(1 << 30)
    closed = np.full(n + 1, far, np.int32)  # where the nearest thing behind a place ends that no oligo may hold
    for found in ends:
        own = closed[: len(found)]
        np.minimum(own, np.where(found < none, place[: len(found)] + found, far), out=own)
    closed = np.minimum(np.minimum.accumulate(closed[::-1])[::-1] - place, none).astype(near)
    opened, tail = None, None if d.max_self_end is None else d.max_self_end + 1
    if tail is not None and tail <= min(high, words.WIDE):
        ahead, back = (x[::-1] for x in words.spelled(c, tail))
        m = len(ahead)
        opened = least(high - tail + 1, m, lambda j: ahead[: m - j] == back[j:])[::-1]
    return sums, closed, opened


def fitting(c: np.ndarray, d: Design, probe: bool, known: tuple | None = None) -> dict[int, np.ndarray]:
    """For each size the places of a text (codes; 4 is no base) at which an acceptable oligo of it begins, whatever its temperature by nearest neighbours.

    Bases are counted by running sums. An oligo binds its copy in more than m bases if a word of m + 1 and that word's reverse complement lie in it: for each place the nearest
    end of two such words behind it is kept, so all sizes are decided by a comparison. Its 3' end is looked up backwards in the same way. ``known``: ``limits`` of at least
    these sizes.
    """
    low, _, high, gc_min, gc_max, tm_min, tm_max, _ = _bounds(d, probe)
    sums, closed, opened = known or limits(c, d, high)
    n, kind, tail = len(c), sums.dtype.type, 1 + (d.max_self_end or 0)
    out, count = {}, np.arange(high + 1)
    for k in range(low, high + 1):
        g = count[: k + 1]
        tm = 2.0 * (k - g) + 4.0 * g if k < 14 else 64.9 + 41.0 * (g - 16.4) / k
        good = (100.0 * g / k >= gc_min) & (100.0 * g / k <= gc_max)
        if not d.nearest_neighbours:
            good &= (tm >= tm_min) & (tm <= tm_max)
        good = np.flatnonzero(good)  # neighbouring numbers, as both rise with them
        if n < k or not len(good):
            out[k] = np.zeros(0, np.int64)
            continue
        m = n - k + 1
        fine = (sums[k:] - sums[:m] - kind(good[0]) <= kind(good[-1] - good[0])) & (closed[:m] > k)
        if opened is not None and k >= tail:
            fine &= opened[k - tail : k - tail + m] > k - tail
        out[k] = np.flatnonzero(fine)
    return out


def _bounds(d: Design, probe: bool):
    """Sizes (least, best, most), bounds of gc, of the temperature, and its best."""
    if probe:
        return d.probe_size_min, d.probe_size_opt, d.probe_size_max, d.probe_gc_min, d.probe_gc_max, d.probe_tm_min, d.probe_tm_max, d.probe_tm_opt
    return d.size_min, d.size_opt, d.size_max, d.gc_min, d.gc_max, d.tm_min, d.tm_max, d.tm_opt


def temperatures(c: np.ndarray, sums: np.ndarray, p: np.ndarray, k: int, d: Design) -> tuple[np.ndarray, np.ndarray]:
    """gc and tm of the oligos of ``k`` bases at places ``p`` of a text (codes; sums of G and C before each place), by the same terms as ``functions.sequence``."""
    gc = (sums[p + k] - sums[p]).astype(np.int64)
    if not d.nearest_neighbours:
        return 100.0 * gc / k, 2.0 * (k - gc) + 4.0 * gc if k < 14 else 64.9 + 41.0 * (gc - 16.4) / k
    own = np.ones(len(p), bool)
    for j in range(k):
        own &= c[p + j] == 3 - c[p + k - 1 - j]
    other, sums = str.maketrans("ACGT", "TGCA"), []
    both = STACKS | {x[::-1].translate(other): v for x, v in STACKS.items()}
    for which in (0, 1):
        table, total = np.array([both[x + y][which] for x in "ACGT" for y in "ACGT"]), np.zeros(len(p))
        for j in range(k - 1):
            total = total + table[c[p + j] * 4 + c[p + j + 1]]
        end = np.array([TERMINAL_AT[which], TERMINAL_GC[which], TERMINAL_GC[which], TERMINAL_AT[which]])
        sums.append(total + end[c[p]] + end[c[p + k - 1]])
    entropy = sums[1] + np.where(own, SYMMETRY, 0.0) + 0.368 * (k - 1) * np.log(d.salt)
    return 100.0 * gc / k, 1000.0 * sums[0] / (entropy + GAS * np.log(np.where(own, d.strands, d.strands / 4))) - 273.15


class Oligos:
    """Acceptable oligos of a text (codes), by place and size: ``pos``, ``n``, ``gc``, ``tm``, ``penalty``."""

    def __init__(self, c: np.ndarray, text: bytes, d: Design, probe: bool, known: tuple | None = None):
        self.text, sizes, sums = text, [], np.concatenate(([0], np.cumsum((c == 1) | (c == 2), dtype=np.int32)))
        _, opt, high, _, _, tm_min, tm_max, tm_opt = _bounds(d, probe)
        far = [x for x in (d.max_self, d.max_self_end) if x is not None and words.WIDE <= x < high]
        for k, p in fitting(c, d, probe, known).items():
            gc, tm = temperatures(c, sums, p, k, d)
            keep = (tm >= tm_min) & (tm <= tm_max)
            if far and keep.any():
                own = [text[i : i + k].decode() for i in p.tolist()]
                keep &= apart(own, own, d.max_self, d.max_self_end)
            p, gc, tm = p[keep], gc[keep], tm[keep]
            sizes.append((p, np.full(len(p), k), gc, tm, abs(k - opt) + np.abs(tm - tm_opt)))
        self.pos, self.n, self.gc, self.tm, self.penalty = (np.concatenate(x) for x in zip(*sizes, strict=True))
        order = np.lexsort((self.n, self.pos))
        self.pos, self.n, self.gc, self.tm, self.penalty = (x[order] for x in (self.pos, self.n, self.gc, self.tm, self.penalty))

    def spelled(self, at: np.ndarray) -> list[str]:
        return [self.text[i : i + k].decode() for i, k in zip(self.pos[at].tolist(), self.n[at].tolist(), strict=True)]


def _inner(probes: Oligos, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The best probe in each stretch that has one: least penalty, then the first, then the shortest."""
    lo, hi = np.searchsorted(probes.pos, begin), np.searchsorted(probes.pos, end)
    each = np.repeat(np.arange(len(begin)), hi - lo)
    at = words.inside(lo, hi - lo)
    ok = probes.pos[at] + probes.n[at] <= end[each]
    each, at = each[ok], at[ok]
    order = np.lexsort((at, probes.penalty[at], each))
    return at[order][np.searchsorted(each[order], np.arange(len(begin)))]


def _meet(word: np.ndarray, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, at_once: int = 10_000) -> np.ndarray:
    """For each two stretches whether any of the ``n`` words from ``a`` is one of the ``m`` words from ``b``."""
    if len(a) > at_once:
        cuts = range(0, len(a), at_once)
        return np.concatenate([_meet(word, *[x[i : i + at_once] for x in (a, n, b, m)]) for i in cuts])
    out, each = np.zeros(len(a), bool), []
    for start, size in ((a, n), (b, m)):
        i = np.arange(size.max(initial=0))[:, None]
        each.append((word[np.minimum(start + i, len(word) - 1)], i < size))
    (x, x_ok), (y, y_ok) = each
    for own, ok in zip(x, x_ok, strict=True):
        out |= ((y == own) & y_ok).any(0) & ok
    return out


def _first(keys: tuple[np.ndarray, ...], n: int) -> np.ndarray:
    """Numbers of the first ``n`` rows of each group by ``keys``, the group first, in order."""
    order = np.lexsort(keys[::-1])
    group = keys[0][order]
    return order[np.arange(len(order)) - np.searchsorted(group, group) < n]


def _pairs_of(rows: list[tuple], d: Design, take: int | None):
    """(pairs as columns, numbers of rows to look at again) of pieces (name, seq_id, seq, own, offset). With ``take`` only so many of the best pairs of a genome are looked at, and
    genomes whose pairs are more but mostly bind each other are left to a look at all."""
    names, ids, seqs, own, offset = (list(x) for x in zip(*rows, strict=True))
    text = "\n".join(seqs).encode("ascii", "replace")
    c = words.CODES[np.frombuffer(text, np.uint8)]
    begin = np.concatenate(([0], np.cumsum([len(s) + 1 for s in seqs]))).astype(np.int64)
    own, offset = np.array(own, np.int64), np.array(offset, np.int64)
    number = lambda x: np.unique(np.array(x, object), return_inverse=True)[1]
    group, record = number(names), number(ids)
    known = limits(c, d, max(d.size_max, d.probe_size_max if d.probe else 0))
    o = Oligos(c, text, d, False, known)
    row = np.searchsorted(begin, o.pos, "right") - 1
    place = o.pos - begin[row] + offset[row]
    left = np.flatnonzero(o.pos - begin[row] < own[row])
    lo = np.searchsorted(o.pos, np.maximum(o.pos[left] + o.n[left], o.pos[left] + d.product_min - d.size_max))
    hi = np.maximum(np.searchsorted(o.pos, np.minimum(o.pos[left] + d.product_max - d.size_min, begin[row[left] + 1] - 1), "right"), lo)
    busy = hi > lo
    left, lo, hi = left[busy], lo[busy], hi[busy]
    probes = first = None
    if d.probe and len(left):
        probes = Oligos(c, text, d, True, known)
        first = np.full(len(c) + 1, np.int64(1 << 60))
        first[probes.pos[::-1]] = (probes.pos + probes.n)[::-1]  # the shortest of a place last
        first = np.minimum.accumulate(first[::-1])[::-1]
    keep, seen = (np.zeros(0, np.int64),) * 3, np.zeros(len(rows), np.int64)
    limited = d.max_pair is not None or d.max_pair_end is not None

    def ordered(a, b, penalty, n):
        at = _first((group[row[a]], penalty, record[row[a]], place[a], place[b], o.n[a], o.n[b]), n)
        return a[at], b[at], penalty[at]

    spelled = {w: words.ahead(c, w) for x in (d.max_pair, d.max_pair_end) if x is not None and (w := x + 1) <= words.WIDE}

    def free(a, b):
        """As ``apart``: the second oligo is the reverse complement of the text at ``b``, so both bind in what the texts at ``a`` and ``b`` share."""
        out = np.ones(len(a), bool)
        for w, end in ((x + 1, end) for x, end in ((d.max_pair_end, True), (d.max_pair, False)) if x is not None):
            if w > words.WIDE:
                continue  # longer than any primer, or decided below
            at = np.flatnonzero(out)
            x, y, n, m = o.pos[a[at]], o.pos[b[at]], np.maximum(o.n[a[at]] - w + 1, 0), np.maximum(o.n[b[at]] - w + 1, 0)
            if end:
                one = np.ones(len(at), np.int64)
                out[at] &= ~(_meet(spelled[w], x + n - 1, np.minimum(n, one), y, m) | _meet(spelled[w], x, n, y, np.minimum(m, one)))
            else:
                out[at] &= ~_meet(spelled[w], x, n, y, m)
        if any(x is not None and words.WIDE <= x < d.size_max for x in (d.max_pair, d.max_pair_end)):
            other, at = str.maketrans("ACGT", "TGCA"), np.flatnonzero(out)
            out[at] = apart(o.spelled(a[at]), [x[::-1].translate(other) for x in o.spelled(b[at])], d.max_pair, d.max_pair_end)
        return out

    def best(a, b, penalty, most):
        """The first free pairs of each genome, looked at in order, each time four times as many, up to ``most``."""
        a, b, penalty = ordered(a, b, penalty, len(a))
        g = group[row[a]]
        rank, good, step = np.arange(len(a)) - np.searchsorted(g, g), np.zeros(len(a), bool), (0, d.num_return)
        while True:
            lacking = np.bincount(g[good], minlength=len(rows)) < d.num_return
            now = np.flatnonzero((rank >= step[0]) & (rank < min(step[1], most)) & lacking[g])
            if not len(now):
                return ordered(a[good], b[good], penalty[good], d.num_return)
            good[now] = free(a[now], b[now])
            step = step[1], 4 * step[1]

    total, at = np.cumsum(hi - lo), 0
    while at < len(left):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        a, b = np.repeat(left[at:end], (hi - lo)[at:end]), words.inside(lo[at:end], (hi - lo)[at:end])
        at = end
        size = o.pos[b] + o.n[b] - o.pos[a]
        ok = (size >= d.product_min) & (size <= d.product_max)
        if d.probe:
            ok &= first[np.minimum(o.pos[a] + o.n[a], len(c))] <= o.pos[b]
        a, b, off = a[ok], b[ok], (size - d.product_opt)[ok]
        penalty = o.penalty[a] + o.penalty[b] + np.where(off < 0, -off * d.wt_lt, off * d.wt_gt)
        penalty = np.floor(penalty * 1e6 + 0.5) / 1e6
        seen += np.bincount(group[row[a]], minlength=len(rows))
        new = [np.concatenate(x) for x in zip(keep, (a, b, penalty), strict=True)]
        new = [x.astype(np.int64) for x in new[:2]] + [new[2]]
        keep = best(*new, 1 << 60) if limited and take is None else ordered(*new, take if limited else d.num_return)
    a, b, penalty = keep
    again = np.zeros(len(rows), bool)
    if limited and take is not None and len(a):
        a, b, penalty = best(a, b, penalty, take)
        again = (np.bincount(group[row[a]], minlength=len(rows)) < d.num_return) & (seen > take)
        good = ~again[group[row[a]]]
        a, b, penalty = a[good], b[good], penalty[good]
    cols = {
        "name": [names[i] for i in row[a].tolist()], "seq_id": [ids[i] for i in row[a].tolist()], "penalty": penalty,
        "lpos": place[a], "ln": o.n[a], "lseq": o.spelled(a), "ltm": o.tm[a], "lgc": o.gc[a], "rpos": place[b], "rn": o.n[b], "rsite": o.spelled(b), "rtm": o.tm[b], "rgc": o.gc[b],
        "ppos": np.full(len(a), -1), "pn": np.zeros(len(a), np.int64), "pseq": [""] * len(a), "ptm": np.zeros(len(a)), "pgc": np.zeros(len(a)),
    }
    if d.probe and len(a):
        q = _inner(probes, o.pos[a] + o.n[a], o.pos[b])
        cols |= {"ppos": probes.pos[q] - o.pos[a] + place[a], "pn": probes.n[q], "pseq": probes.spelled(q), "ptm": probes.tm[q], "pgc": probes.gc[q]}
    return cols, np.flatnonzero(again[group]).tolist()


_PAIRED = "penalty double, lpos long, ln long, lseq string, ltm double, lgc double, rpos long, rn long, rsite string, rtm double, rgc double, ppos long, pn long, pseq string, ptm double, pgc double"
_FOUND = f"name string, seq_id string, {_PAIRED}, seq string, own int, offset int"
_TYPES = {"string": pa.string(), "double": pa.float64(), "long": pa.int64(), "int": pa.int32()}


def _found(batches, d: Design, take: int | None):
    """The best pairs of the pieces, and, without pairs, the pieces whose pairs must all be looked at."""
    kinds = {n: _TYPES[t] for n, t in (x.split() for x in _FOUND.split(", "))}

    def out(rows):
        pairs, again = _pairs_of(rows, d, take)
        n, m = len(pairs["name"]), len(again)
        piece = {x: [rows[i][j] for i in again] for j, x in enumerate(("name", "seq_id", "seq", "own", "offset"))}
        cols = [pa.chunked_array([pa.array(pairs.get(x, [None] * n), t), pa.array(piece.get(x, [None] * m), t)]).combine_chunks() for x, t in kinds.items()]
        return pa.RecordBatch.from_arrays(cols, names=list(kinds))

    held, size = [], 0
    for batch in batches:
        for r in zip(*[batch.column(x).to_pylist() for x in ("name", "seq_id", "seq", "own", "offset")], strict=True):
            held.append(r)
            size += len(r[2])
            if size >= AT_ONCE:
                yield out(held)
                held, size = [], 0
    if held:
        yield out(held)


def _best(sequences: DataFrame, d: Design) -> DataFrame:
    """The best pairs of each genome, with ``rank``: those of its pieces, and of these the first."""
    ship(sequences.sparkSession)
    rows = sequences.where("name is not null and seq_id is not null and seq is not null").select("name", "seq_id", F.upper("seq").alias("seq"))
    rows = pieces(rows, 0, d.product_max, LARGE, 100 * LARGE).select("name", "seq_id", "seq", "own", "offset")
    order, take = ["penalty", "seq_id", "lpos", "rpos", "ln", "rn"], 4 * d.num_return
    some = stored(rows.mapInArrow(lambda b: _found(b, d, take), _FOUND), "some")
    best = some.where("penalty is not null").drop("seq", "own", "offset")
    again = some.where("penalty is null").select("name", "seq_id", "seq", "own", "offset")
    if not again.select("own").isEmpty():  # few bases and many pairs: by their bytes one task would get them all
        parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * rows.sparkSession.sparkContext.defaultParallelism)
        rest = again.repartition(parts, "name", "seq_id", "offset").mapInArrow(lambda b: _found(b, d, None), _FOUND)
        best = best.unionByName(stored(rest, "rest").drop("seq", "own", "offset"))
    return top_n(best, "name", order, d.num_return)


def design_primer_pairs(sequences: DataFrame, design: Design = Design()) -> DataFrame:
    """The best pairs of each genome, in the columns of primer tables, with penalty; names are numbered by rank.

    With ``probe``, only pairs that have room for an acceptable probe between their primers, each with its best one (least penalty, then the first, then the shortest).
    Pairs whose primers bind each other more than allowed are passed over and the next best come up.
    """
    best = _best(sequences, design).withColumn("size", F.col("rpos") + F.col("rn") - F.col("lpos"))
    return best.select(
        F.format_string("%s_primer_%05d", "name", "rank").alias("name"), F.col("size").cast("long").alias("size"),
        F.col("lseq").alias("forward_seq"), (F.col("lpos") + 1).cast("long").alias("forward_start"), F.col("ln").cast("long").alias("forward_length"), F.col("ltm").alias("forward_tm"), F.col("lgc").alias("forward_gc"),
        reverse_complement(F.col("rsite")).alias("reverse_seq"), (F.col("rpos") + 1).cast("long").alias("reverse_start"), F.col("rn").cast("long").alias("reverse_length"), F.col("rtm").alias("reverse_tm"), F.col("rgc").alias("reverse_gc"),
        F.col("pseq").alias("internal_seq"), (F.col("ppos") + 1).cast("long").alias("internal_start"), F.col("pn").cast("long").alias("internal_length"), F.col("ptm").alias("internal_tm"), F.col("pgc").alias("internal_gc"),
        F.col("seq_id").alias("source"), F.col("name").alias("sourcename"), "penalty",
    )


def top_n(rows: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of each group, with their rank from 1."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= n)
