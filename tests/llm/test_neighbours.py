import numpy as np
import pytest

from cohortmark.llm import neighbours as N


def brute(rows, n, every):
    """(query_id, rank) -> score of the exact search over rows of one length."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for k, (i, v) in enumerate(ok):
        if i % every == 0:
            near = sorted((-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), j) for m, (j, w) in enumerate(ok) if m != k and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near[:n])]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'k' AS key", "1 AS vec", "2 AS ids", "0 AS rank").repartition(3)


def recall(got, want):
    worst = {}
    for q, _, _, s in want:
        worst[q] = min(worst.get(q, 9), s)
    return sum(r.score >= worst[r.query_id] - 1e-9 for r in got) / len(want)


@pytest.mark.parametrize("kind", ["random", "clusters"])
def test_recall(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 48)).astype(np.float32)
    if kind == "clusters":
        x = (x[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 48))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = N.nearest(table(spark, rows), 25).collect(), brute(rows, 5, 25)
    assert len(got) == len(want) and recall(got, want) >= 0.93
    held = {(q, j): s for q, _, j, s in brute(rows, 2999, 1500)}
    assert all(abs(held[r.query_id, r.vec_id] - r.score) < 1e-12 for r in got if r.query_id % 1500 == 0)


def test_copies_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(8)
    few = rng.normal(size=(30, 6)).round(2)
    rows = [(i, few[i % 30].tolist() if i % 3 else few[0].tolist()) for i in range(200)]  # a third are one vector
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (404, [float("nan")] * 6), (405, [float("inf")] * 6), (None, few[1].tolist())]
    rows += [(50, few[3].tolist()), (50, few[3].tolist()), (500, [1.0, 2.0]), (501, [2.0, 4.0]), (-100, few[5].tolist()), (550, [1e38] + [0.0] * 5), (600, [1e-38] + [0.0] * 5)]
    want = brute([(i, None if v is None else [None if a is None else float(np.float32(a)) for a in v]) for i, v in rows], 5, 50)
    got = N.nearest(table(spark, rows), 50).collect()
    key = lambda q, r, s: (q, r, round(s, 9))
    assert sorted(key(r.query_id, r.rank, r.score) for r in got) == sorted(key(q, r, s) for q, r, _, s in want)
    # copies score the same to the last bit, so the smaller ids come first
    first = {r.rank: r.vec_id for r in got if r.query_id == 150}
    assert [first[k] for k in range(1, 6)] == [0, 3, 6, 9, 12]


def test_few_rows_and_none(spark):
    assert N.nearest(table(spark, [(0, [1.0, 2.0])])).count() == 0
    got = N.nearest(table(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])])).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 1), (0, 2, 2)]
    assert N.nearest(table(spark, [])).count() == 0


@pytest.mark.parametrize("radius", [0, 5, 12, 23, 40, 64])
def test_every_code_within_the_radius_is_found(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 1 << 63, (4000, 2), np.uint64)
    near = codes[rng.integers(0, 4000, 20)].copy()
    for i, q in enumerate(near):
        for b in rng.choice(128, i, replace=False):
            q[b // 64] ^= np.uint64(1 << (int(b) % 64))
    q, r = N.within(N.Buckets(codes), codes, near, np.full(20, radius))
    assert sorted(zip(q.tolist(), r.tolist(), strict=True)) == sorted(zip(*[x.tolist() for x in np.nonzero(N.bits_apart(near, codes) <= radius)], strict=True))
