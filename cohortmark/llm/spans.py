"""Spans found in texts: their order, their text form and digest, and cheap tests that rule texts out."""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import functions as F

SPAN = "struct<start:long,rank:int,end:long,kind:string>"


def text_form(spans: list[tuple[int, int, int, str]]) -> str:
    """kind:start:end by start, then rank of the kind, joined by commas. Spans are (start, rank, end, kind)."""
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


def digest(spans: list[tuple[int, int, int, str]]) -> str:
    return hashlib.sha256(text_form(spans).encode()).hexdigest()


class Taken:
    """Places that spans cover, asked for in logarithmic time."""

    def __init__(self, spans):
        self.start, self.end = [], []
        for s, e in sorted(spans):
            if self.end and s <= self.end[-1]:
                self.end[-1] = max(self.end[-1], e)
            else:
                self.start.append(s)
                self.end.append(e)

    def free(self, s: int, e: int) -> bool:
        """True if no span has a place of [s, e)."""
        i = bisect_right(self.start, e - 1) - 1
        return i < 0 or self.end[i] <= s


def as_struct(span: tuple[int, int, int, str]) -> dict:
    return dict(zip(("start", "rank", "end", "kind"), span, strict=True))


def joined(spans: F.Column) -> F.Column:
    """The text form of an array of span structs."""
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def longest_runs(inside: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Length of the longest run of true bytes in each row."""
    out = np.zeros(len(off) - 1, np.int64)
    if not len(inside):
        return out
    edge = inside.copy()
    start = np.zeros(len(inside), bool)
    start[off[:-1][off[:-1] < len(inside)]] = True
    edge[1:] &= ~inside[:-1] | start[1:]
    first = np.flatnonzero(edge)
    if len(first):
        last = inside.copy()
        last[:-1] &= ~inside[1:] | start[1:]
        np.maximum.at(out, np.searchsorted(off, first, "right") - 1, np.flatnonzero(last) - first + 1)
    return out
