"""Exact encoding and decoding with a merge-type (BPE) SentencePiece model, by backtracking.

A segmentation is the model's own exactly if each piece re-merges to itself and each two neighbours, merged again from
their characters, come out as these two pieces. So the encoder takes the longest piece that an Aho-Corasick automaton finds at
a place, checks it against the piece before by re-merging the two, tries shorter pieces else, and steps back where none
fits; a bitfield keeps the places from which no way leads on. The result equals the library's merge order, in time that
does not grow with the number of merges. The short chunks of a batch of texts take these steps side by side, as arrays.

Only the vocabulary and scores are read through the sentencepiece library. Supported are models of merge type with byte fallback and
the identity normaliser, which is what the given tokenizer has; others raise.

Decoding is of a document's own ids, one after the other. Of equal merges the leftmost goes first, as in the library.

Nulls count as empty texts (no ids, empty decoded text). Texts of any length are encoded whole. Repeated rows give
repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import held, per_batch

SPACE = "▁"
ONE = (1,)
#: Chunks whose encoding a task remembers, in each of two generations.
REMEMBERED = 200_000
#: Neighbour checks of long chunks that a task remembers.
REMEMBERED_PAIRS = 200_000
#: Neighbour checks of short chunks, and moves of their automaton, that a task remembers: so many bits, each at the place that its hash gives.
MEMO_BITS = 20
#: Longest chunk that is remembered and goes through the arrays; chunks there at a time; characters of texts that look up chunks together.
SHORT, AT_ONCE, TEXTS_AT_ONCE = 64, 20_000, 1 << 20


class Memo:
    """Numbers that a function gives for keys below 2 ** 42, for arrays of keys. A newer key takes the place of one that shares its slot."""

    def __init__(self, function: Callable[[int], int]):
        self.function, self.slots = function, np.full(1 << MEMO_BITS, -1, np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - MEMO_BITS)).view(np.int64)
        known = self.slots[slot]
        new = np.flatnonzero(known >> 21 != keys)
        if len(new):
            each, which = np.unique(keys[new], return_inverse=True)
            known[new] = (each << 21 | np.fromiter(map(self.function, each.tolist()), np.int64, len(each)))[which]
            self.slots[slot[new]] = known[new]
        return known & (1 << 21) - 1


class Codec:
    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if sp.encode("ａ  b ") != sp.encode("ａ") + sp.encode("a  b ")[1:]:
            raise ValueError("only the identity normaliser is supported")
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.piece) if sp.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError("only models with byte fallback are supported")
        #: What an id, in decimal digits, stands for.
        self.stands_for = {str(i): p.replace(SPACE, " ").encode() for i, p in enumerate(self.piece)}
        self.stands_for |= {str(i): bytes((b,)) for b, i in self.byte_id.items()}
        self.stands_for |= {str(i): b"" if sp.is_control(i) else " \u2047 ".encode() for i in range(len(self.piece)) if sp.is_control(i) or sp.is_unknown(i)}
        plain = [i for i in range(len(self.piece)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.id_of = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: sp.get_score(i) for i in plain}
        self.fits: dict[str, dict[str, bool]] = {}
        self.n_fits = 0
        self.runs: dict[str, tuple[list[float], list[str], list[str]]] = {}  # bounded by pieces and characters
        self.longest = ahocorasick.Automaton()
        usable = 0
        for p, i in self.id_of.items():
            if len(p) > 1 and self.run(p)[1][-1] == p:
                self.longest.add_word(p, i)
                usable += 1
        if usable:
            self.longest.make_automaton()
        self.size = np.array([len(p) for p in self.piece], np.int64)
        #: For each character the number of its piece; one that is no piece has its own number after all pieces.
        self.char = len(self.piece) + np.arange(0x110000, dtype=np.int64)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        if int(self.char.max()) >> 21:
            raise ValueError("only models with fewer than 900,000 pieces are supported")
        self.pairs = Memo(lambda pair: self.remerges(self.named(pair >> 21), self.named(pair & (1 << 21) - 1)))
        # the automaton's states are all beginnings of pieces; a state stands for the longest one that ends at a place
        usable = set(self.longest.keys()) if usable else set()
        self.begun = [""] + sorted({p[:i] for p in usable for i in range(1, len(p) + 1)})
        self.state = {p: i for i, p in enumerate(self.begun)}
        self.moves = Memo(lambda move: self.moved(self.begun[move >> 21] + self.named(move & (1 << 21) - 1)))
        ending = [[self.id_of[p[i:]] for i in range(len(p) - 1) if p[i:] in usable] for p in self.begun]
        self.n_ending = np.array([len(x) for x in ending], np.int64)
        self.ending_from = np.cumsum(self.n_ending) - self.n_ending
        self.ending = np.array([i for x in ending for i in x], np.int64)
        many = [p for p in self.score if len(p) > 1]
        used = set().union(*many)
        self.apart = next(c for c in map(chr, range(0xD800)) if c not in used)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in many):
            self.cut = re.compile(r"(?s).+")
        else:  # no piece crosses from a word to the space after it, nor holds these characters beside others
            alone = "".join(re.escape(c) for c in map(chr, range(32)) if not any(c in p for p in many))
            self.cut = re.compile(f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.chunks, self.digits = Chunks(self), Digits(self)

    def run(self, piece: str) -> tuple[list[float], list[str], list[str]]:
        """Merging ``piece`` from its characters, best score first, leftmost among equals: the score of each merge; the first
        and the last part before each merge and at the end."""
        parts, score = list(piece), self.score
        scores, first, last = [], [parts[0]], [parts[-1]]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            scores.append(best)
            first.append(parts[0])
            last.append(parts[-1])
        self.runs[piece] = (scores, first, last)
        return self.runs[piece]

    def remerges(self, left: str, right: str) -> bool:
        """True if merging the characters of both, best score first, never merges across their border."""
        p, _, last = self.runs.get(left) or self.run(left)
        q, first, _ = self.runs.get(right) or self.run(right)
        i = j = 0
        get, n, m = self.score.get, len(p), len(q)
        while True:
            across = get(last[i] + first[j])
            if across is not None and (i == n or across > p[i]) and (j == m or across >= q[j]):
                return False
            if i < n and (j == m or p[i] >= q[j]):
                i += 1
            elif j < m:
                j += 1
            else:
                return True

    def compatible(self, left: str, right: str) -> bool:
        known = self.fits.get(left)
        if known is None:
            known = self.fits[left] = {}
        found = known.get(right)
        if found is None:
            if self.n_fits >= REMEMBERED_PAIRS:
                self.fits, self.n_fits = {left: (known := {})}, 0
            found = known[right] = self.remerges(left, right)
            self.n_fits += 1
        return found

    def split(self, text: str) -> list[str]:
        """The pieces of a text in which spaces are already marked."""
        n = len(text)
        if n == 1:
            return [text]
        at: list = [ONE] * n  # lengths of pieces that start here, rising
        if len(self.longest):
            for end, i in self.longest.iter(text):
                size = len(self.piece[i])
                start = end - size + 1
                at[start] = (*at[start], size)
        dead = None  # bit i: no way on from place i; made at the first such place
        out: list[str] = []
        tried: list[int] = []  # which length each piece of out is
        pos, k, fits = 0, len(at[0]) - 1, self.compatible
        while pos < n:
            sizes = at[pos]
            while k >= 0:
                end = pos + sizes[k]
                if dead is None or not dead[end >> 3] >> (end & 7) & 1:
                    piece = text[pos:end]
                    if not out or fits(out[-1], piece):
                        out.append(piece)
                        tried.append(k)
                        pos = end
                        k = len(at[pos]) - 1 if pos < n else 0
                        break
                k -= 1
            else:
                if not out:
                    raise ValueError("the model has no consistent segmentation")
                if dead is None:
                    dead = bytearray((n >> 3) + 1)
                dead[pos >> 3] |= 1 << (pos & 7)
                pos -= len(out.pop())
                k = tried.pop() - 1
        return out

    def named(self, number: int) -> str:
        return self.piece[number] if number < len(self.piece) else chr(number - len(self.piece))

    def moved(self, text: str) -> int:
        """The automaton's state after a text: its longest end that begins a piece."""
        while text not in self.state:
            text = text[1:]
        return self.state[text]

    def matches(self, char: np.ndarray, begin: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End and number of all pieces of several characters in chunks, all chunks moving through the automaton side by side."""
        order = np.argsort(-long, kind="stable")
        at, long = begin[order], long[order]
        state = np.zeros(len(char), np.int64)
        now = np.zeros(len(at), np.int64)
        for i in range(int(long[0])):
            m = int(np.searchsorted(-long, -i))  # chunks longer than i
            place = at[:m] + i
            now = self.moves(now[:m] << 21 | char[place])
            state[place] = now
        n = self.n_ending[state]
        end = np.repeat(np.arange(len(char)), n)
        return end, self.ending[np.repeat(self.ending_from[state] - np.cumsum(n) + n, n) + np.arange(len(end))]

    def split_each(self, chunks: list[str]) -> Iterator[str]:
        """``split`` for short chunks, giving ids as text: each step is taken for all chunks that are not through."""
        long = np.fromiter(map(len, chunks), np.int64, len(chunks))
        text = self.apart.join(chunks) + self.apart
        n = len(text)
        stop = np.cumsum(long + 1) - 1
        begin = stop - long
        # all pieces that start at each place, shortest first
        char = self.char[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        last, piece = self.matches(char, begin, long)
        size = self.size[piece]
        each = np.sort(np.concatenate([np.arange(n) << 28 | 1 << 21 | char, last + 1 - size << 28 | size << 21 | piece]))
        piece, start = each & (1 << 21) - 1, each >> 28
        end = start + (each >> 21 & 127)
        n_from = np.bincount(start, minlength=n)
        upto = np.cumsum(n_from)
        first = upto - n_from
        came = np.full(n, -1, np.int64)  # the piece by which a place was reached
        dead = np.zeros((n >> 3) + 1, np.uint8)  # bit i: no way on from place i
        pos, goal, k = begin.copy(), stop, upto[begin] - 1
        while len(pos):
            left = k >= first[pos]
            stuck = np.flatnonzero(~left)
            if len(stuck):
                at = pos[stuck]
                back = came[at]
                if (back < 0).any():
                    raise ValueError("the model has no consistent segmentation")
                np.bitwise_or.at(dead, at >> 3, (1 << (at & 7)).astype(np.uint8))
            go = np.flatnonzero(left)
            x, before = k[go], came[pos[go]]
            to = end[x]
            fits = (dead[to >> 3] >> (to & 7) & 1) == 0
            check = np.flatnonzero(fits & (before >= 0))
            fits[check] = self.pairs(piece[before[check]] << 21 | piece[x[check]]) == 1
            k[go[~fits]] -= 1
            on, to = go[fits], to[fits]
            came[to] = x[fits]
            pos[on], k[on] = to, upto[to] - 1
            if len(stuck):
                pos[stuck], k[stuck] = start[back], back - 1
            more = pos < goal
            if not more.all():
                pos, goal, k = pos[more], goal[more], k[more]
        taken = np.zeros(len(piece), bool)
        at, low = stop, begin
        while len(at):
            x = came[at]
            taken[x] = True
            more = start[x] > low
            at, low = start[x][more], low[more]
        taken = np.flatnonzero(taken)
        ids, bounds = list(map(self.digits.__getitem__, piece[taken].tolist())), np.searchsorted(start[taken], begin).tolist()
        for a, b in zip(bounds, [*bounds[1:], len(ids)], strict=True):
            yield ",".join(ids[a:b])

    def ids(self, pieces: list[str]) -> list[int]:
        out, known = [], self.id_of
        for p in pieces:
            i = known.get(p)
            if i is None:
                out += [self.byte_id[b] for b in p.encode()]
            else:
                out.append(i)
        return out

    def marked(self, text: str) -> list[str]:
        """Chunks that encode independently."""
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for c in self.marked(text or "") for i in self.chunks[c].split(",")]

    def encode_each(self, texts: Iterable[str | None]) -> Iterator[str]:
        """The ids of each text, in decimal digits between commas."""
        together, n = [], 0
        for text in texts:
            together.append(self.marked(text or ""))
            n += len(text or "")
            if n >= TEXTS_AT_ONCE:
                yield from self.chunks.of_each(together)
                together, n = [], 0
        yield from self.chunks.of_each(together)

    def decode(self, ids) -> str:
        """The text of ids, given as numbers or as decimal digits, without the space before the first word."""
        text = b"".join(map(self.stands_for.__getitem__, map(str, ids))).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class Chunks(dict):
    """chunk -> its ids as text; two generations bound the memory."""

    def __init__(self, codec: Codec):
        self.codec, self.old = codec, {}

    def __missing__(self, chunk: str) -> str:
        found = self.old.get(chunk)
        if found is None:
            found = ",".join(map(str, self.codec.ids(self.codec.split(chunk))))
        if len(chunk) <= SHORT:
            self.keep(chunk, found)
        return found

    def keep(self, chunk: str, ids: str) -> None:
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids

    def of_each(self, texts: list[list[str]]) -> Iterator[str]:
        """The ids of each text's chunks; new short chunks are split together."""
        new = [c for c in set().union(*texts) if c not in self and c not in self.old and len(c) <= SHORT]
        for i in range(0, len(new), AT_ONCE):
            for chunk, ids in zip(new[i : i + AT_ONCE], self.codec.split_each(new[i : i + AT_ONCE]), strict=True):
                self.keep(chunk, ids)
        for chunks in texts:
            yield ",".join(map(self.__getitem__, chunks))


class Digits(dict):
    """Number of a piece -> its ids as text, those of its bytes if it is a character without a piece."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, number: int) -> str:
        found = ",".join(map(str, self.codec.ids([self.codec.named(number)])))
        if number < len(self.codec.piece):
            self[number] = found
        return found


@lru_cache(maxsize=2)
def codec(model_path: str) -> Codec:
    held["piece_codec"] = codec.cache_clear
    return Codec(model_path)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the ids of each text, without begin and end."""

    def step(batches):
        c = codec(model_path)
        for batch in batches:
            ids = [[int(i) for i in csv.split(",")] if csv else [] for csv in c.encode_each(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return per_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), step, "doc_id long, ids array<int>", keep="piece_codec")


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text of each row's ids; null ids give an empty text."""

    def step(batches):
        c = codec(model_path)
        for batch in batches:
            texts = [c.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return per_batch(rows.select("doc_id", F.col("ids").cast("array<int>").alias("ids")), step, "doc_id long, text string", keep="piece_codec")


def digests(docs: DataFrame, model_path: str, rows_at_once: int = 256) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them."""

    def step(batches):
        c = codec(model_path)
        for whole in batches:
            for i in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(i, rows_at_once)
                n, ids, texts = [], [], []
                for csv in c.encode_each(batch.column("text").to_pylist()):
                    own = csv.split(",") if csv else []
                    n.append(len(own))
                    ids.append(hashlib.sha256(csv.encode()).hexdigest())
                    texts.append(hashlib.sha256(c.decode(own).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return per_batch(docs, step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", keep="piece_codec")
