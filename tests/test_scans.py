import random

import pytest
from frames import rows

from cohortmark.operators import intervals as I
from cohortmark.operators import scans, tiles


def merged(own):
    out = []
    for s, e in sorted(own):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("parts", [1, 4, 23])
@pytest.mark.parametrize("widths", [(1, 3), (1, 60), (1, 2000)])
def test_merge_across_partitions(spark, parts, widths):
    rng = random.Random(parts * 7 + widths[1])
    own = {k: [(s, s + rng.randint(*widths)) for s in (rng.randrange(2000) for _ in range(n))] for k, n in (("a", 300), (None, 40), ("b", 1), ("c", 200))}
    df = spark.createDataFrame([(k, s, e) for k, v in own.items() for s, e in v] + [("z", None, 3), ("z", 3, None)], "chrom string, start long, end long")
    got = I.interval_merge(df, parts)
    assert rows(got, "chrom", "start", "end") == sorted([(k, *x) for k, v in own.items() for x in merged(v)], key=repr)
    assert "Window" not in plan(got)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_depth_across_partitions(spark, parts):
    rng = random.Random(parts)
    steps = [(k, rng.randrange(30) if k == 2 else rng.randrange(500), rng.choice([-1, 1, 2]), rng.choice([0, 1])) for k in (1, 1, 1, 2, 3) for _ in range(60)] + [(4, 7, 1, 1)]
    want = []
    for k in (1, 2, 3, 4):
        at = sorted({a for q, a, *_ in steps if q == k})
        for x, y in zip(at, at[1:], strict=False):
            before = [s for s in steps if s[0] == k and s[1] <= x]
            want.append((k, x, y, sum(s[2] for s in before), sum(s[3] for s in before)))
    got = scans.depth(spark.createDataFrame(steps, "chrom int, at long, d long, d0 long"), ["chrom"], parts)
    assert rows(got, "chrom", "start", "end", "depth", "first") == sorted(want, key=repr)
    assert scans.depth(spark.createDataFrame([], "chrom int, at long, d long, d0 long"), ["chrom"], parts).count() == 0


def test_interval_algebra_across_partitions(spark):
    rng = random.Random(5)
    sets = [[("c", s, s + rng.randrange(1, 30)) for s in (rng.randrange(700) for _ in range(60))] for _ in range(3)]
    on = [[any(s <= p < e for _, s, e in x) for p in range(760)] for x in sets]
    spans = lambda f: merged([(p, p + 1) for p in range(760) if f(p)])
    frames = [spark.createDataFrame(x, "chrom string, start long, end long") for x in sets]
    for parts in (2, 9):
        assert rows(I.interval_intersect_any(frames[0], frames[1:], parts), "start", "end") == sorted(spans(lambda p: on[0][p] and (on[1][p] or on[2][p])), key=repr)
        assert rows(I.interval_intersect_all(frames, parts), "start", "end") == sorted(spans(lambda p: all(x[p] for x in on)), key=repr)
        lengths = spark.createDataFrame([("c", 700), ("none", 4)], "chrom string, length long")
        want = [(s, min(e, 700)) for s, e in spans(lambda p: p < 700 and not on[0][p])] + [(0, 4)]
        assert rows(I.interval_complement(frames[0], lengths, parts), "start", "end") == sorted(want, key=repr)


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def records(spark, rng):
    own = [("g", f"r{i}", f"d{i}", i, dna(rng, n)) for i, n in enumerate([0, 1, 7, 8, 30, 2])] + [("h", "x", "about", 0, dna(rng, 17)), ("e", "empty", "", 3, "")]
    return own, spark.createDataFrame(own, "name string, seq_id string, description string, ord int, seq string")


@pytest.mark.parametrize("size", [4, 10, 10_000])
def test_tiles_regions_and_stitching(spark, size):
    rng = random.Random(size)
    own, df = records(spark, rng)
    t = tiles.tiled(df, size)
    assert max(len(r.seq) for r in t.collect()) <= size
    assert rows(tiles.assembled(t, ["seq_id"]), "seq_id", "seq") == sorted(((r[1], r[4]) for r in own), key=repr)
    asked = [(r[1], a, a + rng.randrange(0, 14), k) for r in own for k, a in enumerate((0, 3, 9, 25))] + [("r4", 3, 12, 9), ("r4", 3, 12, 9), ("absent", 0, 3, 0)]
    seq = {r[1]: r[4] for r in own}
    want = []
    for i, s, e, k in asked:
        if i in seq:
            s2, e2 = min(max(0, s - 2), len(seq[i])), min(len(seq[i]), e + 2)
            want.append((i, min(s2, e2) if e2 < s2 else s2, max(s2, e2), k, seq[i][s2 : max(s2, e2)]))
    got = tiles.regions(t, spark.createDataFrame(asked, "seq_id string, start int, end int, k int"), "seq_id", 2, size)
    assert rows(got, "seq_id", "start", "end", "k", "seq") == sorted(want, key=repr)
    whole = tiles.assembled(tiles.stitch(t, "NNN", size), ["name", "seq_id", "description", "stitched"])
    joined = "NNN".join(r[4] for r in own if r[0] == "g")
    assert rows(whole, "name", "seq_id", "seq", "stitched") == sorted([("g", "g_concatenated", joined, True), ("h", "x", own[6][4], False), ("e", "empty", "", False)], key=repr)


@pytest.mark.parametrize("size", [5, 64])
def test_filtered_tiles(spark, size):
    rng = random.Random(size)
    own, df = records(spark, rng)
    asked = [("r4", 0, 9, 5), ("r4", 20, 30, 2), ("r3", 2, 4, 7), ("x", 0, 17, 1)]
    got = tiles.assembled(tiles.filtered(tiles.tiled(df, size), spark.createDataFrame(asked, "seq_id string, start int, end int, ord int"), 1, 6, size=size), ["seq_id"])
    seq = {r[1]: r[4] for r in own}
    want = [("N" * 6).join([seq["r4"][19:30], seq["r4"][0:10], seq["r3"][1:5]]), seq["x"]]
    assert rows(got, "seq_id", "seq") == sorted([("g_filtered", want[0]), ("h_filtered", want[1])], key=repr)
