import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import frame, lowered

from cohortmark.llm import lexical

TERM = re.compile(lexical.TERM)


def brute(docs, items, top=lexical.TOP):
    count = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    N, L = sum(1 for _, c in count if c), sum(sum(c.values()) for _, c in count)
    df = Counter(w for _, c in count for w in c)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(TERM.findall(lowered(t)))
    out = []
    for i, own in terms.items():
        found = []
        for d, c in count:
            n = sum(c.values())
            score = 0
            for w in own & c.keys():
                m = 50 + 50 * n * N // L
                score += math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(i, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS part", "1 AS term", "'n' AS n", "2 AS block").repartition(3)
    return d, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS doc_id", "'t' AS term")


def invented(rng, n, words, most):
    return [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randrange(most)))) for i in range(n)]


@pytest.mark.parametrize(("block", "top", "terms"), [(7, 5, 200_000), (4096, 50, 200_000), (16, 3, 20)])
def test_search(spark, monkeypatch, block, top, terms):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "SLICE_TERMS", terms)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "日本", "A1", "x_y", "it's"]
    docs = invented(rng, 200, words, 60) + [(300 + i, "w1 w2, w3!w4") for i in range(40)] + [(900, None), (901, ""), (902, "--- ,"), (None, "w5 w6")]
    items = invented(rng, 9, words, 25) + [(20, "w1 W2 w3"), (20, "w59"), (21, None), (22, "absent"), (None, "w7 w8")]
    got = lexical.search(*tables(spark, docs, items), top)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, top)


def test_hard_and_empty_tables(spark):
    docs = frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "the quick brown one two line"), (2, "w" * 5000), (3, "É日本 tail a b")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical.search(docs, asked).collect()), key=repr) == brute(rows, items)
    assert lexical.search(docs.limit(0), asked).count() == 0
    assert lexical.search(docs, asked.limit(0)).count() == 0


def test_pair_bounds_are_bounds_and_tighter():
    rng = np.random.default_rng(3)
    q = lexical.Queries([0], np.arange(20, dtype=np.uint64), [np.arange(20)])
    held = rng.random((64, 20)) < 0.05
    term, doc = np.nonzero(held.T)
    q.weigh(held.sum(0), 64, 1000)
    impact = q.impacts(term, np.ones(len(term), np.int64), np.full(len(term), 15))
    terms, begin = np.unique(term, return_index=True)
    block = lexical.Block(q, terms, np.append(begin, len(term)), doc, impact)
    block.joint = block.joint_maxima(64)
    order, most = block.bounds(0)
    dense = np.zeros((64, 20), np.int64)
    dense[doc, term] = impact
    for k in range(len(order) + 1):
        assert dense[:, order[:k]].sum(1).max(initial=0) <= most[k] <= block.u[order[:k]].sum()
    assert most[-1] < block.u[order].sum()
    for i, (a, b) in enumerate(q.pairs):
        both = (dense[:, a] > 0) & (dense[:, b] > 0)
        assert block.joint[i] == (dense[both][:, [a, b]].sum(1).max() if both.any() else 0)
