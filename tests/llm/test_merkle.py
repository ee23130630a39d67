import hashlib
import zlib

import numpy as np
import pytest
from helpers import frame

from cohortmark.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    """Rows are (doc_id, source, lang, n_chars, text) with different doc_ids in each lang."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is None, r[0])) for g in langs}
    trees = {g: levels([h(*map(field, r)) for r in own]) for g, own in groups.items()}
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            path = [(p, lv[p ^ 1] if p ^ 1 < len(lv) else None) for tree, at in ((trees[g], i), (top, k)) for s, lv in enumerate(tree[:-1]) for p in [at >> s]]
            hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            got = h(*map(field, (*r[:3], r[3] + 1, r[4]))) if hit else trees[g][0][i]
            for p, s in path:
                got = h(got) if s is None else h(s, got) if p % 2 else h(got, s)
            out.append((r[0], trees[g][0][i], trees[g][-1][0], top[-1][0], h(*[s or "" for _, s in path]), got, got == top[-1][0]))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest(spark, height):
    langs = [None, "", "de", "en", "é", "\U0001f600", "z"]
    rows = [(i, None if i % 5 == 0 else f"s{i % 3}", langs[i % 7 if i < 60 else 3], None if i % 11 == 0 else i, None if i % 13 == 0 else "ü" * (i % 4)) for i in range(150)]
    df = table(spark, rows[::-1]).selectExpr("*", "'x' AS tree", "1 AS pos", "'r' AS rank", "2 AS n", "'b' AS block", "0 AS digest", "1 AS other").repartition(3)
    assert sorted(map(tuple, merkle.manifest(df, height).collect()), key=repr) == brute(rows)


def test_small_tables(spark):
    one = [(7, "a", "en", 3, "abc")]
    got = merkle.manifest(table(spark, one)).collect()
    assert [tuple(r) for r in got] == brute(one) and got[0].root == got[0].leaf and got[0].proof_sha256 == h()
    assert merkle.manifest(table(spark, []), 2).count() == 0


def test_null_and_repeated_ids_are_leaves(spark):
    rows = [(None, None, None, None, None), (None, "a", None, 2**63 - 1, "x"), (5, "a", None, 1, "y"), (5, "a", None, 1, "y"), (5, "a", None, 1, "z" * 200_000)]
    got = merkle.manifest(table(spark, rows), 1).collect()
    assert len(got) == 5 and len({r.root for r in got}) == 1
    assert all(r.verified for r in got if r.doc_id is None)
    assert {r.leaf for r in got} == {h(*map(field, r)) for r in rows}


def test_places_are_a_permutation_with_whole_subtrees():
    for levels_ in range(1, 12):
        at = np.concatenate([merkle.place(levels_, d, np.arange(1 << d)) for d in range(levels_)])
        assert sorted(at.tolist()) == list(range((1 << levels_) - 1))
    # of four levels the upper two are the first three places, and each lower tree of two levels is three neighbours
    assert merkle.place(4, 1, np.arange(2)).tolist() == [1, 2]
    assert [merkle.place(4, 2, np.array([k]))[0] for k in range(4)] == [3, 6, 9, 12]
    assert merkle.place(4, 3, np.arange(8)).tolist() == [4, 5, 7, 8, 10, 11, 13, 14]


def test_hard_texts(spark):
    df = frame(spark).selectExpr("*", "length(text) AS n_chars").dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    assert sorted(map(tuple, merkle.manifest(df, 1).collect()), key=repr) == brute(rows)
