"""Personal data: fixed patterns, and a skip-chain conditional random field over the tokens around them.

Nodes of the field are tokens with a digit or an @; all others are outside by definition. Neighbouring nodes share a chain potential;
repeats (the same digits in a run of neighbouring number tokens, whatever their spelling, or the same address) anywhere in a document share
a skip potential with a hub node for their key, so the number of edges grows with the tokens. Tokens inside base spans are observed, and so
are hubs that they alone name. Loopy message passing then gives every other node its label, and what is surely not outside becomes an added
span (``crf_<kind>``): a number or address that a pattern misses in one place but proves in another.

All weights, of features, chain and skip edges, are learnt together by pseudo-likelihood: each label given those of its neighbours. The sample is bounded
(``TRAIN_DOCS`` documents, by hash of doc_id, at most ``TRAIN_TOKENS`` tokens each) and labelled by the base patterns. As these alone would teach that a
label is what a pattern says, each sampled document also gets, for up to ``RESPELT`` of its spans, the same data in another spelling, with
its label, and other digits in that spelling, outside. Everything else reads every text whole.

Offsets are code points, ends exclusive. Spans with one start stand in the order of kinds. Null and empty texts have no spans. Repeated
rows give repeated results. Texts of any length take time in proportion to it. Extra columns are ignored. Without any labelled token nothing is
added.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .runtime import per_batch, text_steps

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
ADDED = {k: len(KINDS) + i for i, k in enumerate(KINDS)}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match can only begin where no digit stands before: the same matches, without a second look at long digit runs.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: From the start of a token on, and never back: one look at each character.
TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
TRAIN_DOCS, TRAIN_TOKENS, RESPELT = 2000, 200, 3
SURE, ROUNDS, DECAY = 0.8, 8, 1e-2
#: Messages go on beyond ROUNDS until none moves by more than SETTLED, or for MOST_ROUNDS.
SETTLED, MOST_ROUNDS = 1e-3, 200
#: A token that may be part of a spaced number; after a closing mark the number ends.
NUMBER = re.compile(r"[+(]*[0-9][0-9().-]*[,;:!?]?")
#: Four numbers with marks between them, and brackets that may stand around the marks of an address.
DOTTED = re.compile(r"[^0-9]*([0-9]{1,3})[^0-9A-Za-z]{1,3}([0-9]{1,3})[^0-9A-Za-z]{1,3}([0-9]{1,3})[^0-9A-Za-z]{1,3}([0-9]{1,3})[^0-9]*")
BRACKETS = str.maketrans("", "", "[](){}<>")
#: Numbers are compared by their last digits: so many, or all of a number with SHORT digits at least.
LONG, SHORT = 10, 7
CUES = ({"phone", "tel", "telephone", "call", "mobile", "fax"}, {"mail", "email", "e-mail"}, {"ip", "host", "address", "server"}, {"card", "visa", "credit", "cc"})
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in "0123456789@"]] = True


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @ to both sides."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        floor = at + 1
        if found:
            out.append((start, found.end()))
            floor = found.end()
        at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    out = [(s, 0, e, "email") for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in CARD.finditer(text):
        if len(m[0]) >= 12 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


class Nodes:
    """Tokens with a digit or an @, their features, observed labels and edges."""

    def __init__(self, text: str, base: list[tuple[int, int, int, str]], most: int | None = None):
        found = []
        for m in TOKEN.finditer(text):
            found.append(m.span())
            if most and len(found) >= most:
                break
        self.spans = found
        self.label = np.zeros(len(found), np.int64)
        b = 0
        for i, (s, e) in enumerate(found):
            while b < len(base) and base[b][2] <= s:
                b += 1
            for x in base[b:]:
                if x[0] >= e:
                    break
                if x[2] > s:
                    self.label[i] = 1 + x[1]
                    break
        self.near = np.array([i + 1 < len(found) and not text[found[i][1] : found[i + 1][0]].strip(" ") and found[i + 1][0] - found[i][1] <= 2 for i in range(len(found))], bool)
        edges = [(i, i + 1, 0) for i in range(len(found) - 1) if self.near[i]]
        hubs = [m for m in self.repeats(text, base).values() if len(m) > 1]
        self.hub_label = np.zeros(len(hubs), np.int64)
        for h, places in enumerate(hubs):
            members = sorted({i for place in places for i in place})
            edges += [(i, len(found) + h, 1) for i in members]
            kinds = {int(self.label[i]) for i in members} - {0}
            self.hub_label[h] = kinds.pop() if len(kinds) == 1 else 0
        self.features = []
        for i, (s, e) in enumerate(found):
            token = text[s:e]
            digits = "".join(c for c in token if "0" <= c <= "9")
            before = text[max(0, s - 24) : s].rsplit(maxsplit=1)
            self.features.append(features(token, digits, before[-1].lower().strip(".,:;()") if before else "", i > 0 and self.near[i - 1], self.near[i]))
        self.edges = np.array(edges, np.int64).reshape(-1, 3)

    def repeats(self, text: str, base: list[tuple[int, int, int, str]]) -> dict:
        """Key -> its places, each the tokens that hold it."""
        keys, runs, span, b = {}, [], None, 0
        for i, (s, e) in enumerate(self.spans):
            token = text[s:e]
            bare = token.strip(".,;:()<>[]\"'!?")
            while b < len(base) and base[b][2] <= s:
                b += 1
            own = base[b][:3] if b < len(base) and base[b][0] < e else None
            if "@" in token:
                keys.setdefault(bare.lower().translate(BRACKETS), []).append((i,))
            elif address := DOTTED.fullmatch(token):
                keys.setdefault(".".join(address.groups()), []).append((i,))
            elif NUMBER.fullmatch(token):
                before = text[self.spans[i - 1][0] : self.spans[i - 1][1]] if i else ""
                if runs and runs[-1][-1] == i - 1 and self.near[i - 1] and own == span and token[0] != "+" and before[-1] not in ",;:!?":
                    runs[-1].append(i)
                else:
                    runs.append([i])
            elif sum("0" <= c <= "9" for c in token) >= SHORT:  # a number with letters or marks around it
                runs.append([i])
            span = own
        numbers = []
        for run in runs:
            held = [(i, c) for i in run for c in text[slice(*self.spans[i])] if "0" <= c <= "9"]
            numbers.append((held, "".join(c for _, c in held)))
        short = {len(d) for _, d in numbers if SHORT <= len(d) < LONG}
        for held, digits in numbers:
            ends = [k + 1 for k in range(len(held)) if k + 1 == len(held) or held[k + 1][0] != held[k][0]]
            for n, k in [(LONG, k) for k in ends] + [(n, len(held)) for n in short]:
                if k >= n:
                    keys.setdefault(digits[k - n : k], []).append(tuple(sorted({i for i, _ in held[k - n : k]})))
        return keys


def features(token: str, digits: str, before: str, left: bool, right: bool) -> list[int]:
    n, dots, size = len(digits), token.count("."), len(token)
    out = [0, 1 + int(np.searchsorted([1, 4, 7, 9, 12, 20], n, "right")), 8 + min(dots, 4), 13 + int(np.searchsorted([4, 8, 16], size, "right"))]
    flags = ("@" in token, token[:1] == "+", "-" in token, "(" in token, ":" in token, any(c.isalpha() for c in token), left, right, 12 <= n <= 19 and luhn(digits), *(before in c for c in CUES))
    return out + [17 + i for i, f in enumerate(flags) if f]


N_FEATURES = 30


def matrix(rows: list[list[int]]) -> np.ndarray:
    x = np.zeros((len(rows), N_FEATURES))
    for i, r in enumerate(rows):
        x[i, r] = 1
    return x


def respelt(text: str, base: list[tuple[int, int, int, str]], rng: random.Random, most: int = RESPELT) -> tuple[str, list[tuple[int, int, int, str]]]:
    """``text`` with sentences that hold some of its data, or other digits, in spellings that no pattern knows; and where the data stand."""
    out, spans = text, []
    for start, rank, end, kind in rng.sample(base, min(most, len(base))):
        own = text[start:end]
        for same in (True, False) * 2:
            digits = [c for c in own if "0" <= c <= "9"]
            if kind == "email":
                new = own.replace("@", "[@]") if rng.random() < 0.5 else "<" + own.replace(".", "[.]") + ">"
                if not same:
                    new = "".join(rng.choice("abcdefgh") if c.isalpha() else c for c in new)
            else:
                if not same:
                    digits = [rng.choice("0123456789") for _ in digits]
                if kind == "ip":
                    mark = rng.choice(("[.]", "-", ":"))
                    parts, at = [], 0
                    for p in own.split("."):
                        parts.append("".join(digits[at : at + len(p)]))
                        at += len(p)
                    new = mark.join(parts)
                else:
                    mark, size = rng.choice((" ", ".", " ", "-", "")), rng.choice((3, 4))
                    new = mark.join("".join(digits[i : i + size]) for i in range(0, len(digits), size))
            out += rng.choice((" see ", " also ", "\nno ", " ref ")) + new
            if same:
                spans.append((len(out) - len(new), rank, len(out), kind))
    return out, spans


def taught(text: str, rng: random.Random) -> tuple[list[list[int]], list[int], list[list[int]]]:
    """Features, labels and edges of one training text with its spellings. Other repeats of labelled data are unknown (label -1)."""
    base = base_spans(text)
    longer, more = respelt(text, base, rng)
    known = base_spans(longer)  # digits of a made-up spelling may happen to match
    more = [x for x in more if all(x[2] <= s or x[0] >= e for s, _, e, _ in known)]
    g = Nodes(longer, sorted(known + more), TRAIN_TOKENS + 24 * RESPELT)
    label = g.label.copy()
    of = {}
    for a, b, kind in g.edges:
        if kind:
            of.setdefault(b, []).append(a)
    for members in of.values():
        if any(g.label[a] for a in members):
            for a in members:
                if not g.label[a]:
                    label[a] = -1
    return g.features, label.tolist(), g.edges.tolist()


def neighbours(labels: np.ndarray, edges: np.ndarray, k: int) -> np.ndarray:
    """One-hot labels that each node sees: of the node before, of the node after, of other repeats (their hub)."""
    out = np.zeros((len(labels), 3, k))
    hubs: dict[int, list[int]] = {}
    for a, b, kind in edges:
        if kind:
            hubs.setdefault(b, []).append(a)
        else:
            for at, side, other in ((a, 1, b), (b, 0, a)):
                if labels[other] >= 0:
                    out[at, side, labels[other]] = 1
    for members in hubs.values():
        n = Counter(int(labels[a]) for a in members if labels[a] >= 0)
        for a in members:
            others = [v for v in n if n[v] > (v == labels[a])]
            kinds = [v for v in others if v] or others
            if len(kinds) == 1:  # what the other repeats are
                out[a, 2, kinds[0]] = 1
    return out.reshape(len(labels), 3 * k)


def fitted(rows: list[tuple[list[list[int]], list[int], list[list[int]]]], steps: int = 600, decay: tuple[float, float] = (DECAY, DECAY / 100)) -> dict | None:
    """Weights from (features, labels, edges) of each document, by pseudo-likelihood."""
    k = len(LABELS)
    x, seen, y = [], [], []
    for fs, labels, edges in rows:
        labels = np.array(labels, np.int64)
        if len(labels):
            use = labels >= 0
            x.append(matrix(fs)[use])
            seen.append(neighbours(labels, edges, k)[use])
            y.append(labels[use])
    if not y or not (y := np.concatenate(y)).any():
        return None
    x = np.concatenate([np.concatenate(x), np.concatenate(seen)], axis=1)
    want, w, speed = np.eye(k)[y], np.zeros((x.shape[1], k)), np.full((x.shape[1], k), 1e-8)
    weight = np.where(y > 0, 1.0, max(1.0, (y > 0).sum()) / max(1, (y == 0).sum())) if (y == 0).sum() > (y > 0).sum() else np.ones(len(y))
    held = np.where(np.arange(x.shape[1]) < N_FEATURES, *decay)[:, None]  # what repeats say counts for more than how a token looks
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        step = x.T @ ((want - p) * weight[:, None]) / weight.sum() - held * w
        speed += step * step
        w += 0.5 * step / np.sqrt(speed)
    before, after, skip = (w[N_FEATURES + i * k : N_FEATURES + (i + 1) * k] for i in range(3))
    # An edge's potential is one table: a chain edge was learnt from both of its ends, a skip edge is symmetric.
    return {"w": w[:N_FEATURES], "pair": np.stack([(before + after.T) / 2, (skip + skip.T) / 2])}


def beliefs(node: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals by loopy sum-product with damping, when messages have settled."""
    total = node
    if len(edges):
        src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        back = np.concatenate([np.arange(len(edges), 2 * len(edges)), np.arange(len(edges))])
        psi = np.concatenate([pair[edges[:, 2]], pair[edges[:, 2]].transpose(0, 2, 1)])
        msg = np.zeros((len(src), node.shape[1]))
        for r in range(MOST_ROUNDS):
            total = node.copy()
            np.add.at(total, dst, msg)
            new = np.logaddexp.reduce((total[src] - msg[back])[:, :, None] + psi, axis=1)
            new = 0.5 * msg + 0.5 * (new - new.max(axis=1, keepdims=True))
            moved, msg = np.abs(new - msg).max(), new
            if r + 1 >= rounds and moved < SETTLED:
                break
        total = node.copy()
        np.add.at(total, dst, msg)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added(text: str, base: list[tuple[int, int, int, str]], model: dict, sure: float) -> list[tuple[int, int, int, str]]:
    g = Nodes(text, base)
    if not len(g.label) or g.label.all():
        return []
    node = matrix(g.features) @ model["w"]
    node = np.vstack([node, np.zeros((len(g.hub_label), node.shape[1]))])
    label = np.concatenate([g.label, g.hub_label])
    seen = label > 0
    node[seen] = -1e6  # however many neighbours say otherwise
    node[seen, label[seen]] = 0.0
    p = beliefs(node, g.edges, model["pair"])[: len(g.label)]
    best = p.argmax(axis=1)
    taken = S.Taken((s, e) for s, _, e, _ in base)
    out, i = [], 0
    while i < len(best):
        k = best[i]
        if seen[i] or not k or p[i, k] < sure:
            i += 1
            continue
        j = i
        while g.near[j] and j + 1 < len(best) and not seen[j + 1] and best[j + 1] == k and p[j + 1, k] >= sure:
            j += 1
        s, e = g.spans[i][0], g.spans[j][1]
        while e > s and not text[e - 1].isalnum():
            e -= 1
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        if taken.free(s, e) and e > s:
            kind = LABELS[k]
            out.append((s, ADDED[kind], e, f"crf_{kind}"))
        i = j + 1
    return out


def train(docs: DataFrame, most: int = TRAIN_DOCS) -> dict | None:
    """Fit on at most ``most`` documents, those of the smallest hashes."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("doc_id", F.lit(3)).alias("h")).orderBy("h", "doc_id").limit(most).select("doc_id")
    sample = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text")  # at most ``most`` ids

    def step(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                if text and re.search("[0-9@]", text):
                    rows.append(taught(text, random.Random(len(text))))
            lists = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((lists, pa.list_(pa.int64()), lists))], names=["f", "y", "e"])

    got = per_batch(sample, step, "f array<array<bigint>>, y array<bigint>, e array<array<bigint>>").toArrow()
    rows = sorted(zip(*(got.column(c).to_pylist() for c in ("f", "y", "e")), strict=True), key=repr)
    return fitted(rows)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def pii(docs: DataFrame, sure: float = SURE, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(docs, train_docs)

    def step(batches):
        for batch in batches:
            for i, j, data, off in text_steps(batch.column("text")):
                at = np.concatenate(([0], np.cumsum(MARK[data])))
                marked = at[off[1:]] > at[off[:-1]]
                texts = batch.column("text").slice(i, j - i)
                cols = ([], [], [], [], [], [], [])
                for r in range(j - i):
                    text = texts[r].as_py() if marked[r] else ""
                    base = base_spans(text) if text else []
                    more = added(text, base, model, sure) if text and model else []
                    n = Counter(k for *_, k in base)
                    for c, v in zip(cols, (*(n[k] for k in KINDS), S.digest(base), S.text_form(base + more), len(more)), strict=True):
                        c.append(v)
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return per_batch(docs, step, SCHEMA)
