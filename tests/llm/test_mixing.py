import numpy as np
from helpers import HARD, frame, words

from cohortmark.llm import mixing as M


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out


def rows():
    rng = np.random.default_rng(3)
    out = []
    for i in range(400):
        source = "hot" if i % 3 else f"s{i % 7}"
        out.append((i, " ".join(f"w{k}" for k in range(int(rng.integers(0, 300)))), "en", source))
    return out + [(1000 + i, "tiny words here", "en", "atiny") for i in range(3)] + [(2000, None, None, None), (2001, "a b", "en", None)]


def check(spark, data, near):
    got = M.mix(frame(spark, data)).collect()
    assert len(got) == len(data)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken <= 3 * r.size
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    for s, n in taken.items():
        assert abs(n - want[s]) <= near * want[s] + 2 * M.BLOCK_WORDS
    return sorted(map(repr, got))


def test_mix_against_brute_force(spark):
    data = rows()
    first = check(spark, data, 0.05)
    assert check(spark, data, 0.05) == first
    spark_sizes = {r.doc_id: r.size for r in M.mix(frame(spark, data)).collect()}
    assert all(spark_sizes[i] == len(words(t)) for i, t, *_ in data)


def test_hard_and_empty(spark):
    check(spark, HARD, 1.0)
    assert M.mix(frame(spark).limit(0)).count() == 0
    empty = [(1, "", "en", "a"), (2, None, "en", None)]
    assert [r.taken for r in M.mix(frame(spark, empty)).collect()] == [0, 0]


def test_mixed_documents_hold_what_is_taken(spark):
    data = rows()
    taken = {r.doc_id: r.taken for r in M.mix(frame(spark, data)).collect()}
    docs = frame(spark, data, extra=False).selectExpr("*", "length(text) AS n_chars")
    got, sums = M.mixed_documents(docs), {}
    assert got.columns == docs.columns
    text = {i: t for i, t, *_ in data}
    for r in got.collect():
        sums[r.doc_id] = sums.get(r.doc_id, 0) + len(words(r.text))
        assert set(words(r.text)) <= set(words(text[r.doc_id])) and r.n_chars == len(r.text)
    assert sums == {i: n for i, n in taken.items() if n}


def test_mixed_documents_tell_rows_apart(spark):
    data = [(5, " ".join(f"a{k}" for k in range(300)), "en", "x")] * 2 + [(5, " ".join(f"b{k}" for k in range(700)), "en", "x"), (None, " ".join(f"c{k}" for k in range(300)), "en", "y"), (None, None, "en", "y")]
    docs = frame(spark, data, extra=False).selectExpr("*", "'p' AS pieces", "1 AS uid", "2 AS slot", "length(text) AS n_chars", "7 AS epoch")
    planned = sum(r.taken for r in M.mix(docs).collect())
    got = M.mixed_documents(docs).collect()
    assert abs(planned - 1600) <= 2 * M.BLOCK_WORDS
    assert sum(len(words(r.text)) for r in got) == planned and {r.doc_id for r in got} == {5, None}
    assert all(r.pieces == "p" and r.uid == 1 and r.epoch == 7 for r in got)
    assert M.mixed_documents(docs.limit(0)).columns == docs.columns


def test_shards_draw_multinomial_counts_of_fixed_totals(spark):
    total = {0: 10_000, 1: 25_000, 2: 65_000, 3: 7}
    sources = spark.createDataFrame([(s, n // 2 + 1, n) for s, n in total.items()], "source_id long, blocks long, total long")
    got = M.dealt(sources, 500, 11).collect()
    assert len(got) == sum(total.values())
    count = np.zeros((201, 4))
    for r in got:
        count[r.shard, r.source_id] += 1
    assert count.sum(0).tolist() == list(total.values()) and set(count.sum(1)[:200]) == {500}
    share = np.array([total[s] for s in range(3)]) / sum(total.values())
    spread, wanted = count[:200, :3].std(0), np.sqrt(500 * share * (1 - share))
    assert (abs(spread / wanted - 1) < 0.2).all()
    held = {(r.source_id, r.epoch, r.block) for r in got}
    assert len(held) == len(got)  # no block twice in an epoch
    assert sorted(map(tuple, got)) == sorted(map(tuple, M.dealt(sources, 500, 11).collect()))


def test_mixed_documents_with_clashing_columns(spark):
    data = rows()[:60] + [(None, "a b c", "en", "hot"), (3, "d e f", "en", "hot")]
    docs = frame(spark, data, extra=False).selectExpr("*", "doc_id * 3 AS __row", "'mine' AS row", "'t' AS __text", "'u' AS whole", "1 AS pieces", "2 AS at", "'d' AS `a.b`")
    got = M.mixed_documents(docs)
    assert got.columns == docs.columns
    rows_ = got.collect()
    assert rows_ and all((r["__row"], r.row, r["__text"], r.whole, r.pieces, r["at"], r["a.b"]) == (None if r.doc_id is None else r.doc_id * 3, "mine", "t", "u", 1, 2, "d") for r in rows_)


def test_ranks_and_sums_without_one_task(spark):
    from cohortmark.llm.runtime import ranked

    rng = np.random.default_rng(5)
    data = [(int(k), i) for i, k in enumerate(rng.integers(0, 90, 500))]
    got = sorted(map(tuple, ranked(spark.createDataFrame(data, "k long, i long").repartition(7), M.F.col("k"), M.F.col("i"), before="k").select("rank", "k", "i", "before").collect()))
    want, total = [], 0
    for n, (k, i) in enumerate(sorted(data)):
        want.append((n, k, i, total))
        total += k
    assert got == want


def test_permutation():
    for n in (1, 2, 3, 5, 64, 1000):
        for key in (1, 99):
            got = M.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(got.tolist()) == list(range(n))
