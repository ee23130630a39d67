from collections import Counter

import corpus_pipeline as P
from helpers import frame, words

from test_mixing import rows as mixing_rows
from test_quality import corpus


def data():
    rows = corpus()
    rows += [(5000 + i, t, lang, s) for i, (_, t, lang, s) in enumerate(rows[:10])]  # exact copies
    rows += [(6000 + i, t + f" extra{i}", lang, s) for i, (_, t, lang, s) in enumerate(rows[:10])]  # near copies
    return rows + mixing_rows()[-5:]


def test_stages_take_effect(spark):
    docs = frame(spark, data(), extra=False).selectExpr("*", "cast(length(text) AS bigint) AS n_chars")
    columns, counts, ids = docs.columns, [], []
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, ""), name)
        counts.append(docs.count())
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    assert 900 not in ids[0] and len(ids[0]) >= 165  # junk goes, clean documents stay
    assert not any(5000 <= i < 6000 for i in ids[1]) and len(ids[1]) == len(ids[0]) - 10
    assert not any(i >= 6000 for i in ids[2]) and len(ids[2]) == len(ids[1]) - 10
    assert ids[3] <= ids[2] and counts[4] == counts[3] and counts[3] > 0
    assert len(P.STAGES) == 5


def test_null_ids_and_repeated_rows_go_through(spark):
    good = corpus()[:125]
    texts = [r[1] for r in good]
    rows = good[:100] + good[:1] * 4 + [(None, t, "en", "a") for t in [*texts[100:120], texts[100], texts[100]]] + [(101, t, "en", "a") for t in texts[120:]]
    docs = frame(spark, rows, extra=False).selectExpr("*", "cast(length(text) AS bigint) AS n_chars")
    own = sorted([(r[0], r[1]) for r in good[:100]] + [(None, t) for t in texts[100:120]] + [(101, t) for t in texts[120:]], key=repr)
    after = []
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, ""), name)
        after.append(docs.collect())
    assert len(after[0]) == len(rows)
    for got in after[1:3]:
        assert sorted([(r.doc_id, r.text) for r in got], key=repr) == own
    held, total = {}, 0
    for i, t in own:
        held.setdefault(i, []).append(Counter(words(t)))
        total += len(words(t))
    taken = [(r.doc_id, Counter(words(r.text))) for r in after[3]]
    assert all(any(not c - h for h in held[i]) for i, c in taken)
    assert 0.9 * total <= sum(c.total() for _, c in taken) <= 1.1 * total
    assert sum(i is None for i, _ in taken) >= 10 and len(after[4]) == len(after[3])


def test_clashing_columns_and_an_empty_table(spark):
    good = corpus()[:60]
    rows = good[:50] + [(None, good[50][1], "en", "a"), (good[0][0], good[51][1], "en", "a"), good[1]]
    names = ["__row", "row", "__text", "__at", "at", "__doc_id", "own", "first_at", "id", "n", "kept", "a.b"]
    docs = frame(spark, rows, extra=False).selectExpr("*", "cast(length(text) AS bigint) AS n_chars", *[f"concat('{n}', md5(text)) AS `{n}`" for n in names])
    mine = {tuple(r[n] for n in names) for r in docs.collect()}
    columns, empty = docs.columns, docs.limit(0)
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, ""), name)
        assert docs.columns == columns and {tuple(r[n] for n in names) for r in docs.collect()} <= mine
        empty = P.stored(stage(spark, empty, ""), name)
        assert empty.columns == columns and empty.count() == 0
    assert docs.count() > 40
    assert P.STAGES[-1][1](spark, docs, "").count() == docs.count() and P.STAGES[-1][1](spark, empty, "").count() == 0
