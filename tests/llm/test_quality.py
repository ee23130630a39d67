import math
import random
import re
from collections import Counter

import numpy as np
from helpers import HARD, frame, words

from cohortmark.llm import bytescan as B
from cohortmark.llm import quality as Q


def brute(text):
    text, w = text or "", words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def corpus():
    rng, rows = random.Random(1), []
    syllables = ["an", "er", "th", "in", "ou", "re", "st", "on"]
    for i in range(150):
        lines = [" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 20))) for _ in range(12)]
        rows.append((100 + i, ".\n".join(lines), "en", "a"))
    rows.append((900, " ".join("#$%&"[rng.randrange(4)] * 3 + "qxzj"[rng.randrange(4)] * 4 + str(i) for i in range(90)), "en", "a"))
    return rows


def test_measures_on_hard_rows(spark):
    rows = HARD + corpus()
    got = {}
    for r in Q.quality(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in rows:
        for r in got[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t)
            assert not (r.base_failed and r.kept)
    assert not got[900][0].base_failed and not got[900][0].kept
    assert all(got[100 + i][0].kept for i in range(150) if not got[100 + i][0].base_failed)
    assert Q.quality(frame(spark).limit(0)).count() == 0


def test_model_is_a_distribution(spark):
    docs = Q.prepared(frame(spark, corpus()))
    m, tongue = Q.sent(Q.model(docs), 0, None), docs.select("tongue").first()[0]
    for context in ("nere", "then", "x#qz", "  .a"):
        head = 0
        for b in context.encode():
            head = head << Q.BITS | int(Q.CLASS[b])
        p = np.exp(m.logp(np.full(64, tongue), np.array([head << Q.BITS | c for c in range(64)])))
        assert math.isclose(p.sum(), 1.0, abs_tol=0.01)


def brute_kneser_ney(texts):
    """Text -> mean negative log-probability under interpolated modified Kneser-Ney over tuples of classes."""
    classes = {t: [int(Q.CLASS[b]) for b in t.encode()] for t in texts}
    counts = {Q.ORDER: Counter(tuple(c[i : i + Q.ORDER]) for c in classes.values() for i in range(len(c) - Q.ORDER + 1))}
    for order in range(Q.ORDER - 1, 0, -1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    off, total, weight = {}, Counter(), Counter()
    for order, own in counts.items():
        n = Counter(own.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        d = [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), most) if n[k] else most for k, most in ((1, 0.95), (2, 1.9), (3, 2.85))]
        for g, k in own.items():
            off[g] = min(d[min(k, 3) - 1], k * 0.999)
            total[g[:-1]] += k
            weight[g[:-1]] += off[g]

    def p(g):
        if not g:
            return 1 / 64
        low = p(g[1:])
        if not total[g[:-1]]:
            return low
        n = counts[len(g)][g]
        return (n - off[g] if n else 0) / total[g[:-1]] + weight[g[:-1]] / total[g[:-1]] * low

    mean = lambda c: -sum(math.log(p(tuple(c[i : i + Q.ORDER]))) for i in range(len(c) - Q.ORDER + 1)) / max(1, len(c) - Q.ORDER + 1)
    return {t: mean(c) for t, c in classes.items()}


def test_perplexity_equals_brute_force_in_any_number_of_slices(spark):
    rows = [(i, t[:400], lang, s) for i, t, lang, s in corpus()[:30]] + [(500 + i, t[300:700] + " é日本", "xx", s) for i, t, _, s in corpus()[30:50]]
    want = {}
    for lang in ("en", "xx"):
        want |= brute_kneser_ney([t for _, t, own, _ in rows if own == lang])
    text = {r[0]: r[1] for r in rows}
    one = {r.doc_id: r.log_perplexity for r in Q.quality(frame(spark, rows)).collect()}
    assert all(math.isclose(v, want[text[i]], rel_tol=1e-5) for i, v in one.items())
    size = sum(t.count() for t in Q.model(Q.prepared(frame(spark, rows))))
    three = {r.doc_id: r.log_perplexity for r in Q.quality(frame(spark, rows + rows[:2]), slice_keys=-(-size // 3)).collect()}
    again = {r.doc_id: r.log_perplexity for r in Q.quality(frame(spark, rows + rows[:2])).collect()}
    assert all(math.isclose(v, again[i], rel_tol=1e-9) for i, v in three.items())


def test_medians(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", 4.0), (None, 5.0), (None, 7.0)], "k string, v double")
    got = {r.by: (round(r.median, 2), r.n) for r in Q.medians(df, df.v, 0.01, "k").collect()}
    assert got == {"a": (2.0, 3), "b": (4.0, 1), None: (5.0, 2)} or got == {"a": (2.01, 3), "b": (4.01, 1), None: (5.01, 2)}


def test_grams_stay_inside_rows():
    texts = [b"abcdef", b"xy", b"", b"ghij"]  # five classes each
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    keys, row = Q.grams(data, off)
    assert row.tolist() == [0, 0]
    first, last, r = B.words(data, off)
    assert list(zip(first.tolist(), last.tolist(), r.tolist(), strict=True)) == [(0, 5, 0), (6, 7, 1), (8, 11, 3)]


def test_copies_do_not_narrow_the_bands(spark):
    rows = [r for r in corpus() if r[0] != 900]
    junk = next(r for r in corpus() if r[0] == 900)
    copies = [(2000 + i, rows[0][1], "en", "a") for i in range(190)]  # with rows[0] 56 % of 'en'
    rare = [(3000 + i, r[1], "xx", "a") for i, r in enumerate(rows[1:3])] + [(3002, rows[3][1], None, "a")]
    got = {r.doc_id: r for r in Q.quality(frame(spark, rows + copies + rare + [junk])).collect()}
    assert sorted(i for i, r in got.items() if not r.base_failed and not r.kept) == [900]
    assert sum(r.kept for r in got.values()) > 0.9 * (len(got) - 1)


def test_slices_are_balanced_and_copies_count_once(spark):
    docs = Q.prepared(frame(spark, corpus(), extra=False))
    tables = Q.model(docs)
    how = Q.deal(tables, 7)
    held = np.zeros(7)
    for t in tables[1:]:
        rows = t.select("tongue", "key").toArrow()
        np.add.at(held, how(rows.column("tongue").to_numpy().astype(np.int64), rows.column("key").to_numpy()), 1)
    assert held.max() <= 1.2 * held.mean() and held.min() > 0
    size = sum(len(Q.sent(tables, k, how).tables[4][0]) for k in range(7))
    assert size == tables[4].count()
    again = Q.taught(Q.prepared(frame(spark, corpus() + [(i, t, lang, s) for i, t, lang, s in corpus()[:20] * 3], extra=False)))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, Q.taught(docs).collect()))
