import random
import re

import numpy as np
from helpers import HARD, frame, lowered, words

from cohortmark.llm import exact_dup, near_dup


def brute_exact(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, len(t or "")))
    keep = {k: min(v, key=lambda x: (-x[1], x[0]))[0] for k, v in groups.items()}
    return sorted((i, keep[k := re.sub(r"[\x20\x09-\x0D]", "", t or "")], len(groups[k]), i == keep[k]) for i, t, *_ in rows)


def test_exact_on_hard_rows(spark):
    got = exact_dup.exact_dup(frame(spark)).select("doc_id", "keep_id", "group_size", "kept")
    assert sorted(map(tuple, got.collect())) == brute_exact(HARD)
    assert exact_dup.exact_dup(frame(spark).limit(0)).count() == 0


def test_exact_hot_group_and_negative_ids(spark):
    rows = [(i, "same text" if i % 3 else f"t {i}", "en", "a") for i in range(-300, 300)]
    got = exact_dup.exact_dup(frame(spark, rows)).select("doc_id", "keep_id", "group_size", "kept")
    assert sorted(map(tuple, got.collect())) == brute_exact(rows)


def test_exact_null_ids_never_win(spark):
    rows = [(None, "a  b", "en", "a"), (4, "ab", "en", "a"), (None, "only", "en", "a")]
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dup.exact_dup(frame(spark, rows)).collect()}
    assert got == {(None, None, 2), (4, None, 2), (None, None, 1)} or got == {(None, 4, 2), (4, 4, 2), (None, None, 1)}


def shingles(text):
    w = words(lowered(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_near(rows):
    sets, up = [(i, shingles(t)) for i, t, *_ in rows], {i: i for i, *_ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(a), top(i), i == top(i)) for i, a in sets)


def test_near_on_hard_rows(spark):
    got = near_dup.near_dup(frame(spark)).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == brute_near(HARD)
    assert near_dup.near_dup(frame(spark).limit(0)).count() == 0


def test_near_chains_and_hot_groups(spark):
    rng, rows, vocab = random.Random(2), [], [f"w{i}" for i in range(500)]
    base = [rng.choice(vocab) for _ in range(120)]
    for i in range(60):  # a chain: each differs a little from the one before
        base = list(base)
        base[rng.randrange(120)] = rng.choice(vocab)
        rows.append((i * 7 % 1000, " ".join(base), "en", "a"))
    hot = [rng.choice(vocab) for _ in range(90)]
    for i in range(60):  # near copies of one text, and texts that share a long passage with it
        own = list(hot)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(90)] = rng.choice(vocab)
        rows.append((1000 + i, " ".join(own), "en", "a"))
        rows.append((2000 + i, " ".join(hot[:60] + [rng.choice(vocab) for _ in range(rng.randrange(5, 60))]), "en", "a"))
    got = near_dup.near_dup(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == brute_near(rows)


def test_signatures_estimate_similarity():
    a = "x " + " ".join(f"w{i}" for i in range(300))
    b = " ".join(f"w{i}" for i in range(50, 350))
    data = [np.frombuffer(t.encode(), np.uint8) for t in (a, b)]
    p, q = (near_dup.shingle_hashes(d, np.array([0, len(d)]))[0] for d in data)
    assert len(np.intersect1d(p, q)) == 246 and len(set(p.tolist())) == 297


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    got = near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.comp) for r in got} == {(x, top(x)) for a, b in edges if a != b for x in (a, b)}
