import random
from collections import Counter

import pytest
from frames import rows

from cohortmark.operators import places as P
from cohortmark.operators import search as H
from cohortmark.operators.sequences import pieces

TEXTS = [("t", "ACGTNRYACGé日ACGTTTACG" * 9), ("a", "A" * 70), ("e", ""), ("n", None), ("s", "AC"), ("p", "".join(random.Random(2).choice("ACGTN") for _ in range(333)))]


def texts(spark):
    return spark.createDataFrame([("g", n, t) for n, t in TEXTS], "name string, seq_id string, seq string")


@pytest.mark.parametrize(("size", "at_once"), [(20, 250_000), (10_000, 60)])
def test_standing_words_against_brute_force(spark, monkeypatch, size, at_once):
    monkeypatch.setattr(P, "AT_ONCE", at_once)
    words = ["ACG", "AAAA", "GTTTACG", "NAC", "TTTTTTTTTTTTTTTTT", "ACGTNRYACGé日A"]
    known = P.few(spark.createDataFrame([(w,) for w in words], "word string"), 6)
    got = P.standing(pieces(texts(spark), 9, 40, size, 10_000), known, 3, 2).selectExpr("seq_id", "start + p AS pos", "substring(seq, p + 1, k) AS word", "p", "seq")
    want = [(n, i, w, min(3, i), t[max(0, i - 3) : i + len(w) + 2]) for n, t in TEXTS for w in words for i in range(len(t or "")) if t[i : i + len(w)] == w]
    assert rows(got, *got.columns) == sorted(want, key=repr) and len(want) > 40
    assert P.few(spark.createDataFrame([(w,) for w in words], "word string"), 5) is None


def test_places_become_rows_only_where_a_word_stands(spark):
    plan = H.search_oligos(spark.createDataFrame([("o", "ACGTACGTACGTACGTACGT")], "oligo string, seq string"), texts(spark), 0.1)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "explode(sequence(lead" not in plan
    plan = H.offtarget_hits(texts(spark), texts(spark).where("seq_id = 'a'"), 9)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "explode(sequence(lead" not in plan.split("MapInArrow")[0]


@pytest.mark.parametrize("k", [1, 6, 12, 15])
def test_word_counts_against_brute_force(spark, k):
    want = Counter(t[i : i + k] for _, t in TEXTS if t for i in range(len(t) - k + 1) if "N" not in t[i : i + k])
    assert rows(H.word_counts(texts(spark), k), "kmer", "n") == sorted(want.items(), key=repr) and len(want) > 3


def test_windows_among_few_and_many_words(spark, monkeypatch):
    words = spark.createDataFrame([("ACGT",), ("AAAA",), ("CCCC",)], "kmer string")
    few = rows(H.windows_among(texts(spark), 4, words), "seq_id", "pos", "kmer")
    monkeypatch.setattr(H, "SENT_WORDS", 2)
    assert few == rows(H.windows_among(texts(spark), 4, words), "seq_id", "pos", "kmer") and len(few) > 60
