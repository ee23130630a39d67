import itertools
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from cohortmark.operators import search as H

COMPLEMENT = str.maketrans("ACGTRYN", "TGCAYRN")


def brute(oligos, texts, mismatch):
    out = []
    for (o, s), strand in itertools.product(oligos, "+-"):
        q = s.upper() if strand == "+" else s.upper()[::-1].translate(COMPLEMENT)
        m = int(mismatch * len(q) + 1e-9)
        size = len(q) // (m + 1)
        for name, t in texts:
            for i in range(len(t) - len(q) + 1 if q else 0):
                site = t[i : i + len(q)].upper()
                n = sum(x != y for x, y in zip(q, site, strict=True))
                parts = [q[j * size : (j + 1) * size] for j in range(m + 1)]
                whole = any(x == site[j * size : (j + 1) * size] and "N" not in x for j, x in enumerate(parts))
                if n <= m and ("N" not in q or whole):
                    out.append((o, strand, name, i, n))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("mismatch", "per_place", "sent"), [(0.0, 0.02, 1000), (0.1, 10.0, 1_000_000), (0.1, 1e-9, 1_000_000), (0.1, 1e-9, 10), (0.2, 1e-4, 10), (0.3, 0.02, 1_000_000)])
def test_search_against_brute_force(spark, mismatch, per_place, sent):
    rng = random.Random(int(mismatch * 10))
    texts = [("t", "".join(rng.choice("ACGT" * 8 + "NR") for _ in range(900))), ("u", "".join(rng.choice("acgt") for _ in range(230))), ("e", ""), ("s", "ACG"), ("a", "A" * 60)]
    oligos = []
    for i in range(24):
        n = rng.choice([18, 20, 22])
        at = rng.choice([0, 900 - n, rng.randrange(0, 900 - n)])
        s = list(texts[0][1][at : at + n])
        for k in rng.sample(range(n), rng.randrange(0, 5)):
            s[k] = rng.choice("ACGTNR")
        oligos.append((f"o{i}", "".join(s)))
    oligos += [("empty", ""), ("a", "A" * 20), ("long", texts[1][1][5:95]), ("twice", oligos[0][1]), ("short", "ACG")]
    asked = spark.createDataFrame([*oligos, oligos[1], ("null", None)], "oligo string, seq string")
    known = spark.createDataFrame([("g", n, t) for n, t in [*texts, ("null", None)]], "name string, seq_id string, seq string")
    want = brute(oligos, texts, mismatch)
    got = H.search_oligos(asked, known, mismatch, per_place, sent)
    assert rows(got, "oligo", "strand", "seq_id", "pos", "mismatches") == want and len(want) >= 20


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], "oligo string, seq string")
    assert H.search_oligos(none, spark.createDataFrame([("g", "t", "ACGT")], "name string, seq_id string, seq string")).count() == 0


@pytest.mark.parametrize("n", [12, 20, 33])
def test_every_spread_of_mismatches_leaves_a_stretch_within_its_bound(n):
    for m, oligos in itertools.product(range(4), (1, 10**3, 10**7)):
        x = H.seeding(n, m, oligos)
        assert len(x.lax) * x.k <= n and sum(j + 1 for j in x.lax) == m + 1
        for spread in itertools.product(range(m + 1), repeat=len(x.lax)):
            assert sum(spread) > m or any(s <= j for s, j in zip(spread, x.lax, strict=True))


def test_candidates_do_not_grow_with_oligos():
    few, many = H.seeding(20, 2, 80), H.seeding(20, 2, 2_000_000)
    assert (few.k, many.k) == (10, 20) and 80 * few.candidates < 0.02 and 2_000_000 * many.candidates < 0.02
    assert H.seeding(20, 2, 8000).k == 10 and H.seeding(20, 2, 8000, sent_words=10).k == 20
    assert H.seeding(20, 2, 2).k == 6 and H.seeding(20, 0, 10**9).lax == (0,)


def test_near_words(spark):
    got = spark.range(1).select(*[F.array_sort(H.near_words(F.lit("ACG"), j)).alias(f"x{j}") for j in range(3)]).first()
    for j in range(3):
        assert got[j] == sorted("".join(w) for w in itertools.product("ACGTN", repeat=3) if sum(a != b for a, b in zip(w, "ACG", strict=True)) <= j)
