import random

import pytest
from frames import rows

from cohortmark.operators import extend as X


def dna(rng, n, letters="ACGT"):
    return "".join(rng.choice(letters) for _ in range(n))


def rc(s):
    return s[::-1].translate(str.maketrans("ACGTRYN", "TGCAYRN"))


def grown(same, e):
    score = best = far = 0
    for i, hit in enumerate(same):
        score += e.reward if hit else e.penalty
        if best - score > e.drop:
            break
        if score > best:
            best, far = score, i + 1
    return far


def brute(oligos, database, e):
    out = set()
    for q, s in oligos:
        for minus, o in ((False, s), (True, rc(s))):
            for d, t in database:
                for shift in range(-len(o), len(t)):
                    same = [0 <= shift + i < len(t) and o[i] == t[shift + i] and o[i] in "ACGT" for i in range(len(o))]
                    for at in range(len(o) - e.word + 1):
                        if all(same[at : at + e.word]):
                            a, b = at - grown(same[:at][::-1], e), at + e.word + grown(same[at + e.word :], e)
                            low, high, n = shift + a + 1, shift + b, len(o)
                            m = sum(same[a:b])
                            out.add((q, d, b - a, b - a - m, *((n - b + 1, n - a, high, low) if minus else (a + 1, b, low, high))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("e", [X.Extension(), X.Extension(word=5, penalty=-2, drop=3), X.Extension(word=4, penalty=-1, drop=1)])
def test_hits_against_brute_force(spark, e):
    rng = random.Random(e.word)
    oligos = [(f"q{i}", dna(rng, rng.randrange(8, 26))) for i in range(12)] + [("amb", "ACGTNACGTRACGTTACGAC"), ("short", "ACG")]
    database = [(f"d{i}", dna(rng, 150)) for i in range(3)] + [("edge", oligos[0][1][3:]), ("none", ""), ("amb", "TTACGTNACGTRACGTTACGACTT")]
    for i in range(6):  # copies with a mismatch or two, on either strand
        o = list(oligos[i][1])
        for k in rng.sample(range(len(o)), 2):
            o[k] = rng.choice("ACGT")
        o = "".join(o)
        database.append((f"m{i}", dna(rng, 203) + (rc(o) if i % 2 else o) + dna(rng, 30)))
    got = X.hits(spark.createDataFrame(oligos, "query string, seq string"), spark.createDataFrame(database, "seq_id string, seq string"), e)
    assert rows(got, "query", "subject", "length", "mismatch", "qstart", "qend", "sstart", "send") == brute(oligos, database, e)


def test_screen_rejects_what_only_an_extended_alignment_exceeds(spark):
    rng = random.Random(2)
    own = dna(rng, 20)
    one_off = own[:12] + ("A" if own[12] != "A" else "C") + own[13:]
    database = spark.createDataFrame([("d", dna(rng, 40) + one_off + dna(rng, 40))], "seq_id string, seq string")
    pairs = spark.createDataFrame([("bad", own, dna(rng, 20)), ("good", dna(rng, 20), dna(rng, 20)), ("gone", dna(rng, 20), rc(own))], "name string, forward_seq string, reverse_seq string")
    from cohortmark.operators.search import screen_offtarget

    assert rows(screen_offtarget(pairs, database, 15), "name") == [("bad",), ("gone",), ("good",)]  # no exact word of 16
    assert rows(X.screen(pairs, database, 15), "name") == [("good",)]
    assert rows(X.screen(pairs, database.limit(0), 15), "name") == [("bad",), ("gone",), ("good",)]


def test_words_sent_or_joined_give_the_same_alignments(spark, monkeypatch):
    rng = random.Random(11)
    text = "".join(rng.choice("ACGT" * 9 + "RN") for _ in range(500))
    oligos = [(f"q{i}", "".join(c if rng.random() < 0.93 else rng.choice("ACGTN") for c in text[i * 9 : i * 9 + rng.choice([10, 11, 20, 33])])) for i in range(50)] + [("e", ""), ("n", None)]
    own, database = spark.createDataFrame(oligos, "query string, seq string"), spark.createDataFrame([("d", text), ("x", text[::-1])], "seq_id string, seq string")
    found = X.hits(own, database)
    few = rows(found, *found.columns)
    plan = found._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan and len(few) > 20
    monkeypatch.setattr(X, "SENT_WORDS", 10)
    assert few == rows(X.hits(own, database), *found.columns)
