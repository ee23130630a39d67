import random
from collections import Counter

from frames import rows

from cohortmark.operators import align, diversity, star


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def family(rng, primer, n, size):
    own, out = dna(rng, size), []
    for i in range(n):
        s = list(own)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, len(s))
            s[at : at + rng.randrange(0, 3)] = rng.choice(["", "A", "GT"])
        out.append((primer, f"{primer}_{i}", "".join(s)))
    return out


def test_rows_of_one_length_with_optimal_pairs(spark):
    rng = random.Random(1)
    data = family(rng, "p", 25, 60) + family(rng, "q", 6, 30) + [("one", "one_0", "ACGT"), ("same", "same_0", "AAC"), ("same", "same_1", "AAC")]
    df = spark.createDataFrame(data, "primer string, amplicon_name string, seq string")
    got = {r.amplicon_name: r.seq for r in star.align_amplicons(df).collect()}
    assert {n: s.replace("-", "") for n, s in got.items()} == {n: s for _, n, s in data}
    centre = {r.primer: r.centre for r in star.centres(df).collect()}
    for p in ("p", "q", "one", "same"):
        own = [(n, s) for q, n, s in data if q == p]
        assert len({len(got[n]) for n, _ in own}) == 1
        count = Counter(s for _, s in own)
        assert centre[p] == max(count, key=lambda s: (count[s], len(s), s))
        middle = next(got[n] for n, s in own if s == centre[p])
        for n, s in own:
            both = [(x, y) for x, y in zip(middle, got[n], strict=True) if (x, y) != ("-", "-")]
            x, y, score = align.aligned([centre[p]], [s])[0]
            pair = lambda r: sum(2 if a == b else -3 for a, b in r if "-" not in (a, b))
            assert pair(both) == pair(zip(x, y, strict=True)) and len(both) == len(x), score
    assert got["one_0"] == "ACGT" and got["same_0"] == "AAC"
    assert star.align_amplicons(df.limit(0)).count() == 0


def test_distances_and_consensus_of_aligned_rows(spark):
    data = [("p", "a", "ACGTACGTAC"), ("p", "b", "ACGTCGTAC"), ("p", "c", "ACGTACGTAC"), ("p", "d", "ACTTACGTAC")]
    out = star.align_amplicons(spark.createDataFrame(data, "primer string, amplicon_name string, seq string"))
    got = {(r.a, r.b): r.dist for r in diversity.pair_distances(out).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {("a", "b"): 0.1, ("a", "c"): 0.0, ("a", "d"): 0.1, ("b", "c"): 0.1, ("b", "d"): 0.2, ("c", "d"): 0.1}
    assert rows(star.consensus(out), "primer", "consensus") == [("p", "ACGTACGTAC")]


def test_gaps_come_with_the_alignments(spark):
    rng = random.Random(2)
    df = spark.createDataFrame(family(rng, "p", 20, 80), "primer string, amplicon_name string, seq string")
    for r in star.pair_alignments(df).collect():
        want, place = [], 0
        for c in r.centre_row:
            if c != "-":
                place += 1
            elif want and want[-1][0] == place:
                want[-1][1] += 1
            else:
                want.append([place, 1])
        assert [[g.place, g.n] for g in r.gaps] == want


def test_primers_of_few_amplicons_meet_once(spark, monkeypatch):
    """Their pairs, columns and rows are no tables; primers of many amplicons are dealt out, with the same rows."""
    rng = random.Random(3)
    data = [x for i in range(12) for x in family(rng, f"p{i:02d}", i + 1, 50)] + [(None, "n", "ACGT"), ("p03", "none", None)]
    data += [("p05", f"copy{i}", data[-3][2]) for i in range(4)]
    df = spark.createDataFrame(data, "primer string, amplicon_name string, seq string")
    names, stored = [], star.stored
    monkeypatch.setattr(star, "stored", lambda rows, name: names.append(name) or stored(rows, name))
    got = rows(star.align_amplicons(df), "primer", "amplicon_name", "seq")
    assert names == ["amplicons", "many"] and len(got) == len(data) - 2
    for few in (0, 6):
        assert rows(star.align_amplicons(df, few=few), "primer", "amplicon_name", "seq") == got
    assert names[-3:] == ["amplicons", "many", "pairs"]


def test_primers_that_batches_cut():
    import pyarrow as pa

    rng = random.Random(4)
    data = [x for i in range(9) for x in family(rng, f"p{i}", 7, 40)]
    table = pa.table({"primer": [x[0] for x in data], "amplicon_name": [x[1] for x in data], "seq": [x[2] for x in data]})
    whole = pa.Table.from_batches(list(star._together(iter(table.to_batches()), align.Scores()))).to_pylist()
    assert [r["seq"].replace("-", "") for r in whole] == [x[2] for x in data]
    for size in (1, 4, 10):
        assert pa.Table.from_batches(list(star._together(iter(table.to_batches(max_chunksize=size)), align.Scores()))).to_pylist() == whole
