import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from cohortmark.operators import degenerate as D

COMPLEMENT = str.maketrans("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")


def brute(oligos, texts, mismatch):
    out = []
    for o, s in oligos:
        s = s.upper().replace("U", "T")
        for strand, q in (("+", s), ("-", s[::-1].translate(COMPLEMENT))):
            for name, t in texts:
                t = "".join(c if c in D.SETS else "N" for c in t.upper().replace("U", "T"))
                for i in range(len(t) - len(q) + 1):
                    n = sum(not set(D.SETS[y]) <= set(D.SETS[x]) for x, y in zip(q, t[i : i + len(q)], strict=True))
                    if n <= int(mismatch * len(q) + 1e-9):
                        out.append((o, strand, name, i, n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("mismatch", [0.0, 0.1, 0.2])
def test_degenerate_oligos_against_brute_force(spark, mismatch):
    rng = random.Random(int(mismatch * 10))
    texts = [("t", "".join(rng.choice("ACGT" * 6 + "RYN") for _ in range(400))), ("u", "".join(rng.choice("acgtx") for _ in range(120))), ("e", "")]
    oligos = []
    for i in range(10):
        at = rng.randrange(0, 380)
        s = list(texts[0][1][at : at + 20])
        for k in rng.sample(range(20), rng.randrange(0, 6)):
            s[k] = rng.choice("RYSWKMBDHVNACGT")
        oligos.append((f"o{i}", "".join(s)))
    oligos += [("mostN", "NNNNNNACGTNNNNNNNNNN"), ("u", "ACGUACGU"), ("long", texts[0][1][30:100])]
    got = D.search(spark.createDataFrame(oligos, "oligo string, seq string"), spark.createDataFrame([("g", n, t) for n, t in texts], "name string, seq_id string, seq string"), mismatch)
    want = brute(oligos, texts, mismatch)
    assert rows(got, "oligo", "strand", "seq_id", "pos", "mismatches") == want and len(want) >= 5


def test_words_of_a_seed(spark):
    got = spark.createDataFrame([("AR",), ("NY",), ("",)], "s string").select("s", D.words(F.col("s")).alias("w"), D.n_words(F.col("s")).alias("n")).collect()
    by = {r.s: r for r in got}
    assert sorted(by["AR"].w) == ["AA", "AG", "AR"] and by["AR"].n == 3
    assert len(by["NY"].w) == by["NY"].n == 45 and by[""].w == [""]


@pytest.mark.parametrize(("sent", "at_once"), [(1_000_000, 1_000_000), (1_000_000, 50), (100, 1_000_000)])
def test_words_sent_or_joined_give_the_same_places(spark, monkeypatch, sent, at_once):
    rng = random.Random(7)
    monkeypatch.setattr(D, "AT_ONCE", at_once)
    texts = [("r", "ACACACACAC" * 30), ("t", "".join(rng.choice("ACGT" * 9 + "RYNK") for _ in range(300))), ("x", "AC"), ("n", None)]
    oligos = [("p", "ACRCACACYCAN"), ("q", "ACRCACACYCAN"), ("long", texts[1][1][10:60]), ("end", texts[1][1][-17:].replace("N", "A")), ("n", "NNNN")]
    frame = spark.createDataFrame([("g", n, t) for n, t in texts], "name string, seq_id string, seq string")
    got = D.search(spark.createDataFrame(oligos, "oligo string, seq string"), frame, 0.1, sent)
    want = brute(oligos, [(n, t) for n, t in texts if t], 0.1)
    assert rows(got, "oligo", "strand", "seq_id", "pos", "mismatches") == want and len(want) > 600
    assert ("MapInArrow" in got._jdf.queryExecution().toString()) == (sent > 100)
