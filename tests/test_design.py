import math
import random

import pytest
from pyspark.sql import functions as F

from cohortmark.functions import sequence as S
from cohortmark.operators import design as D


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def bond(a, b):
    """Longest run of a that pairs with b, and the longest that holds a's last base."""
    r = rc(b)
    runs = [(i, k) for i in range(len(a)) for k in range(1, len(a) - i + 1) if a[i : i + k] in r]
    return max((k for _, k in runs), default=0), max((k for i, k in runs if i + k == len(a)), default=0)


def test_bonds_against_brute_force():
    rng = random.Random(1)
    a = [dna(rng, rng.randrange(1, 25)) for _ in range(200)] + ["ACGT", "AAAA", "GAATTC", "ACNGT"]
    b = [dna(rng, rng.randrange(1, 25)) for _ in range(200)] + ["ACGT", "AAAA", "GAATTC", "ACAGT"]
    most, end = D.bonds(a, b)
    want = [bond(x, y) if "N" not in x else (2, 2) for x, y in zip(a, b, strict=True)]
    assert list(zip(most.tolist(), end.tolist(), strict=True)) == want


def test_nearest_neighbour_temperatures(spark):
    df = spark.createDataFrame([("CGTTGA",), ("GAATTC",), ("ACGTN",), ("A",), ("ACGTTGCAACGGTTACCAGT",)], "s string")
    got = {r.s: r for r in df.select("s", S.stacking(F.col("s"), 0).alias("h"), S.stacking(F.col("s"), 1).alias("e"), S.nearest_neighbour_temp(F.col("s"), 1.0, 1e-4).alias("t")).collect()}
    # a published worked example: free energy at 37 degrees of CGTTGA, -5.35 from rounded terms
    assert abs(got["CGTTGA"].h + 41.2) < 1e-9 and abs(got["CGTTGA"].e + 115.4) < 1e-9
    assert abs(got["CGTTGA"].h - 310.15 * got["CGTTGA"].e / 1000 + 5.35) < 0.1
    assert abs(got["CGTTGA"].t - (1000 * -41.2 / (-115.4 + 1.987 * math.log(1e-4 / 4)) - 273.15)) < 1e-9
    # a sequence that is its own complement loses symmetry and has one kind of strand
    h = 2 * -8.2 + 2 * -7.9 + -7.2 + 2 * 0.1
    e = 2 * -22.2 + 2 * -22.2 + -20.4 + 2 * -2.8 - 1.4
    assert abs(got["GAATTC"].t - (1000 * h / (e + 1.987 * math.log(1e-4)) - 273.15)) < 1e-9
    assert got["ACGTN"].t is None and got["A"].h is None
    back = spark.createDataFrame([(rc("ACGTTGCAACGGTTACCAGT"),)], "s string").select(S.nearest_neighbour_temp(F.col("s"), 1.0, 1e-4)).first()[0]
    assert abs(got["ACGTTGCAACGGTTACCAGT"].t - back) < 1e-9


@pytest.mark.parametrize("bound", [False, True])
def test_pairs_with_probes_against_brute_force(spark, bound):
    rng = random.Random(12)
    texts = {"g": dna(rng, 330), "h": dna(rng, 300)}
    limits = {"max_self": 6, "max_self_end": 4, "max_pair": 4, "max_pair_end": 3} if bound else {}
    d = D.Design(num_return=4, size_min=18, size_max=19, tm_min=44, tm_max=56, tm_opt=50, product_min=70, product_opt=80, product_max=95, probe=True, probe_size_min=15, probe_size_max=17, probe_tm_min=46, probe_tm_opt=50, probe_tm_max=60, **limits)
    s = spark.createDataFrame([(k, "r" + k, t) for k, t in texts.items()], "name string, seq_id string, seq string")
    tm = lambda x: 64.9 + 41.0 * (sum(c in "GC" for c in x) - 16.4) / len(x)

    def fine(x, low, high):
        alone = not bound or (bond(x, x)[0] <= 6 and bond(x, x)[1] <= 4)
        return 30 <= 100 * sum(c in "GC" for c in x) / len(x) <= 80 and low <= tm(x) <= high and not any(b * 4 in x for b in "ACGT") and alone

    def apart(a, b):
        return not bound or (bond(a, b)[0] <= 4 and bond(a, b)[1] <= 3 and bond(b, a)[1] <= 3)

    want = []
    for name, text in texts.items():
        kmers = lambda low, high, a, b, text=text: [(i, text[i : i + k]) for k in range(low, high + 1) for i in range(len(text) - k + 1) if fine(text[i : i + k], a, b)]
        arms, probes = kmers(18, 19, 44, 56), kmers(15, 17, 46, 60)
        pairs = []
        for i, a in arms:
            for j, b in arms:
                size = j + len(b) - i
                inner = [(abs(len(p) - 20) + abs(tm(p) - 50), k, len(p), p) for k, p in probes if k >= i + len(a) and k + len(p) <= j]
                if 70 <= size <= 95 and j >= i + len(a) and inner and apart(a, rc(b)):
                    pairs.append((round(sum(abs(len(x) - 20) + abs(tm(x) - 50) for x in (a, b)) + abs(size - 80), 6), i, j, len(a), len(b), a, b, min(inner)))
        want += [(f"{name}_primer_{k + 1:05d}", i + 1, a, j + 1, rc(b), q[3], q[1] + 1, p) for k, (p, i, j, _, _, a, b, q) in enumerate(sorted(pairs)[:4])]
    got = [(r.name, r.forward_start, r.forward_seq, r.reverse_start, r.reverse_seq, r.internal_seq, r.internal_start, r.penalty) for r in D.design_primer_pairs(s, d).orderBy("name").collect()]
    assert len(want) >= 4 and got == want


def test_fitting_oligos_against_brute_force():
    """Only acceptable oligos become rows: of a text without any there is none, whatever its length."""
    rng, codes = random.Random(5), {"A": 0, "C": 1, "G": 2, "T": 3}
    for case in range(12):
        d = D.Design(probe_size_min=12, probe_size_max=22, probe_tm_min=40, probe_tm_max=60, gc_min=35, max_self=(None, 4, 5, 30)[case % 4], max_self_end=(3, None, 4, 2)[case % 4], poly_x=case % 3 + 2)
        text = "".join(rng.choice("ACGTACGTACGTACGTACGTN") for _ in range(160))
        tm = lambda x: 2.0 * sum(c in "AT" for c in x) + 4.0 * sum(c in "GC" for c in x) if len(x) < 14 else 64.9 + 41.0 * (sum(c in "GC" for c in x) - 16.4) / len(x)
        alone = lambda x, d=d: (d.max_self is None or bond(x, x)[0] <= d.max_self) and (d.max_self_end is None or bond(x, x)[1] <= d.max_self_end)
        fine = lambda x, d=d: "N" not in x and 30 <= 100.0 * sum(c in "GC" for c in x) / len(x) <= 80 and 40 <= tm(x) <= 60 and not any(b * (d.poly_x + 1) in x for b in "ACGT") and alone(x)
        got = D.fitting(D.np.array([codes.get(x, 4) for x in text], D.np.uint8), d, True)
        assert {k: p.tolist() for k, p in got.items()} == {k: [i for i in range(len(text) - k + 1) if fine(text[i : i + k])] for k in range(12, 23)}
    assert sum(len(p) for p in D.fitting(D.np.zeros(100_000, D.np.uint8), D.Design(), False).values()) == 0


def test_genomes_that_lack_free_pairs_are_looked_at_once(spark, monkeypatch):
    """Not again and again for four times as many pairs, each time made anew."""
    import random
    from dataclasses import replace

    from cohortmark.operators import design as D

    rng = random.Random(8)
    data = [(f"g{i}", f"g{i}", "".join(rng.choice("ACGT") for _ in range(140))) for i in range(3)]
    df = spark.createDataFrame(data, "name string, seq_id string, seq string")
    d = D.Design(num_return=2, size_min=20, size_max=20, tm_min=40.0, tm_max=80.0, max_pair=3, max_pair_end=1)
    loose = replace(d, num_return=10**6, max_pair=None, max_pair_end=None)
    every = D.design_primer_pairs(df, loose).collect()
    x, y = [r.forward_seq for r in every], [r.reverse_seq for r in every]
    (most, end), (_, other) = D.bonds(x, y), D.bonds(y, x)
    want: dict = {}
    for r, ok in sorted(zip(every, (most <= 3) & (end <= 1) & (other <= 1), strict=True), key=lambda z: (z[0].sourcename, z[0].name)):
        if ok and len(want.setdefault(r.sourcename, [])) < 2:
            want[r.sourcename].append((r.forward_start, r.forward_length, r.reverse_start, r.reverse_length))
    names, stored = [], D.stored
    monkeypatch.setattr(D, "stored", lambda rows, name: names.append(name) or stored(rows, name))
    got: dict = {}
    for r in sorted(D.design_primer_pairs(df, d).collect(), key=lambda r: r.name):
        got.setdefault(r.sourcename, []).append((r.forward_start, r.forward_length, r.reverse_start, r.reverse_length))
    assert got == want and names.count("some") == 1 and names.count("rest") == 1


def test_pieces_give_the_pairs_of_whole_records(spark, monkeypatch):
    """Only best pairs become rows, not oligos; borders of pieces, of letters and of pairs looked at at once change nothing."""
    rng = random.Random(21)
    data = [("g", "r1", dna(rng, 1500)), ("g", "r2", dna(rng, 700) + "N" * 20 + dna(rng, 500)), ("h", "r3", dna(rng, 900)), ("h", None, dna(rng, 300)), ("i", "r4", None), (None, "r5", dna(rng, 300))]
    df = spark.createDataFrame(data, "name string, seq_id string, seq string")
    names, stored = [], D.stored
    monkeypatch.setattr(D, "stored", lambda rows, name: names.append(name) or stored(rows, name))
    d = D.Design(num_return=5, probe=True, probe_tm_min=50.0, probe_tm_opt=55.0, probe_tm_max=62.0, tm_min=48, tm_max=58, max_self=7, max_self_end=4, max_pair=5, max_pair_end=3, size_max=20)
    want = sorted(map(tuple, D.design_primer_pairs(df, d).collect()))
    assert "oligos" not in names and {r[18] for r in want} == {"g", "h"} and len(want) == 10, want
    rows = [("g" if n == "g" else "h", i, s, len(s), 0) for n, i, s in data[:3]]
    whole, again = D._pairs_of(rows, d, None)
    monkeypatch.setattr(D, "PAIRS", 50)
    cut, _ = D._pairs_of(rows, d, None)
    assert whole["lseq"] == cut["lseq"] and whole["penalty"].tolist() == cut["penalty"].tolist() and not again
    monkeypatch.setattr(D, "LARGE", 230)
    assert sorted(map(tuple, D.design_primer_pairs(df, d).collect())) == want


def test_temperatures_of_arrays_are_those_of_columns(spark):
    rng = random.Random(3)
    text = dna(rng, 300) + "GAATTCGAATTC"
    c = D.words.CODES[D.np.frombuffer(text.encode(), D.np.uint8)]
    sums = D.np.concatenate(([0], D.np.cumsum((c == 1) | (c == 2))))
    for nearest in (False, True):
        d = D.Design(nearest_neighbours=nearest)
        for k in (6, 13, 14, 22):
            p = D.np.arange(len(text) - k + 1)
            df = spark.createDataFrame([(i, text[i : i + k]) for i in p.tolist()], "i int, s string")
            tm = S.nearest_neighbour_temp(F.col("s"), d.salt, d.strands) if nearest else S.melting_temp(F.col("s"))
            want = df.select("i", S.gc_percent(F.col("s")), tm).orderBy("i").collect()
            gc, tm = D.temperatures(c, sums, p, k, d)
            assert gc.tolist() == [r[1] for r in want] and D.np.allclose(tm, [r[2] for r in want], 0, 1e-9)


def test_bonds_by_words_that_texts_share():
    rng = random.Random(9)
    text = "".join(rng.choice("ACCGT") for _ in range(400))
    c = D.words.CODES[D.np.frombuffer(text.encode(), D.np.uint8)]
    a, b = (D.np.array([rng.randrange(370) for _ in range(500)]) for _ in "ab")
    n, m = (D.np.array([rng.randrange(3, 25) for _ in range(500)]) for _ in "ab")
    x, y = [text[i : i + k] for i, k in zip(a, n, strict=True)], [rc(text[i : i + k]) for i, k in zip(b, m, strict=True)]
    for w in (3, 5, 8):
        count = lambda size, w=w: D.np.maximum(size - w + 1, 0)
        got = D._meet(D.words.ahead(c, w), a, count(n), b, count(m), 70)
        assert got.tolist() == (D.bonds(x, y)[0] >= w).tolist()
        end = D._meet(D.words.ahead(c, w), a + count(n) - 1, D.np.minimum(count(n), 1), b, count(m))
        assert end.tolist() == (D.bonds(x, y)[1] >= w).tolist()
