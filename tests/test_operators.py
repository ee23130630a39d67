"""Operators on small hand-made tables, and against brute force on random ones."""

import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from cohortmark.functions import sequence as S
from cohortmark.operators import classify as C
from cohortmark.operators import design as D
from cohortmark.operators import diversity as V
from cohortmark.operators import intervals as I
from cohortmark.operators import manifest as M
from cohortmark.operators import search as H
from cohortmark.operators import sequences as Q

COMPLEMENT = dict(zip("ACGT", "TGCA", strict=True))


def rc(s):
    return "".join(COMPLEMENT.get(c, c) for c in reversed(s))


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_classification_rules(spark):
    man = spark.createDataFrame([("a", ["x", "all"]), ("b", ["x", "all"]), ("c", ["y", "all"])], "name string, groups array<string>")
    primers = spark.createDataFrame([("p1", "a"), ("p2", "c"), ("p3", "b")], "name string, sourcename string")
    # bounds are exclusive; a primer's own genome counts without any amplimer
    amps = spark.createDataFrame([("p1", "b", 100), ("p1", "c", 50), ("p3", "a", 299), ("p3", "c", 51), ("gone", "c", 100)], "primer_name string, target string, length int")
    found = C.classify_primers(man, primers, amps)
    assert rows(found, "group", "primer") == [("all", "p3"), ("x", "p1"), ("y", "p2")]
    more = man.union(spark.createDataFrame([("d", ["empty"])], man.schema))
    assert rows(C.group_summary_outer(C.process_groups(more), found), "group", "n_primers") == [("all", 1), ("empty", 0), ("x", 1), ("y", 1)]


def test_dedupe_and_screen(spark):
    p = spark.createDataFrame([("p2", "g1", "AA", "CC"), ("p1", "g1", "AA", "CC"), ("p0", "g2", "AA", "CC"), ("q", "g1", "CC", "AA")], "name string, sourcename string, forward_seq string, reverse_seq string")
    assert rows(C.dedupe_primers(p), "name") == [("p1",), ("q",)]
    assert rows(C.dedupe_counts(p), "sourcename", "kept", "removed") == [("g1", 2, 1), ("g2", 0, 1)]
    hits = spark.createDataFrame([("p1_fwd", 16), ("q_rev", 15)], "query string, length int")
    assert rows(C.primer_screen_anti(p, hits), "name") == [("p0",), ("p2",), ("q",)]


def brute(sets, keep, top=60):
    out, inside = [], False
    for x in range(top + 1):
        now = x < top and keep([any(a <= x < b for a, b in s) for s in sets])
        if now and not inside:
            start = x
        if inside and not now:
            out.append((start, x))
        inside = now
    return out


@pytest.mark.parametrize("seed", range(3))
def test_intervals_against_brute_force(spark, seed):
    rng = random.Random(seed)
    sets = [[(a := rng.randrange(50), a + rng.randrange(1, 9)) for _ in range(5)] for _ in range(3)]
    frames = [spark.createDataFrame([("c", a, b) for a, b in s], "chrom string, start long, end long") for s in sets]
    for tile in (None, 7):
        assert rows(I.interval_merge(frames[0], tile), "start", "end") == sorted(brute(sets[:1], all), key=repr)
    lengths = spark.createDataFrame([("c", 60), ("empty", 5)], "chrom string, length long")
    assert rows(I.interval_complement(frames[0], lengths), "chrom", "start", "end") == sorted([("c", *x) for x in brute(sets[:1], lambda f: not f[0])] + [("empty", 0, 5)], key=repr)
    assert rows(I.interval_intersect_any(frames[0], frames[1:]), "start", "end") == sorted(brute(sets, lambda f: f[0] and any(f[1:])), key=repr)
    assert rows(I.interval_intersect_all(frames), "start", "end") == sorted(brute(sets, all), key=repr)


def test_common_regions_modes(spark):
    a = spark.createDataFrame([("q", "s1", 0, 10, 5), ("q", "s2", 5, 15, 5), ("q", "s3", 8, 20, 0), ("one", "s1", 1, 3, 9), ("one", "s1", 3, 6, 9)], "query string, subject string, start long, end long, sim_errors long")
    assert rows(I.common_regions(a, min_sim_errors=1), "query", "start", "end") == [("one", 1, 6), ("q", 5, 10)]
    assert rows(I.common_regions(a, min_sim_errors=1, mode="all"), "query", "start", "end") == [("one", 1, 6)]
    assert I.common_regions(a.limit(0)).count() == 0
    flat = spark.createDataFrame([("q", "s", 5, 5, 3)], a.schema)
    assert I.alignment_quality_filter(flat, 0, 0.1).count() == 0


def test_stitch_and_ambiguities(spark):
    s = spark.createDataFrame([("g", "r2", "", 2, "CCR"), ("g", "r1", "", 1, "AA"), ("h", "x", "about", 0, "acr")], "name string, seq_id string, description string, ord int, seq string")
    got = {r.name: r for r in Q.stitch(s).collect()}
    assert got["g"].seq == "AA" + S.SPACER + "CCR" and got["g"].seq_id == "g_concatenated"
    assert got["h"].seq == "acr" and got["h"].seq_id == "x" and got["h"].description == "about"
    assert rows(Q.replace_ambiguities(s), "seq_id", "seq") == [("r1_noambig", "AA"), ("r2_noambig", "CCN"), ("x", "acr")]
    assert rows(M.validate_manifest(s), "name", "requires_stitch", "has_ambiguities") == [("g", True, True), ("h", False, False)]


def test_filtered_sequence(spark):
    s = spark.createDataFrame([("g", "r", 0, "ACGTACGTAC")], "name string, seq_id string, ord int, seq string")
    r = spark.createDataFrame([("r", 0, 2, 0), ("r", 8, 10, 1)], "seq_id string, start int, end int, ord int")
    assert Q.filtered_sequence(s, r, flank=1, spacer_length=3).first()["seq"] == "ACG" + "NNN" + "TAC"


def test_reverse_complement_and_chunks(spark):
    df = spark.createDataFrame([("ACGTRYKMBDHVNSWacgt",)], "s string")
    assert df.select(S.reverse_complement(F.col("s"))).first()[0] == "acgtWSNBDHVKMRYACGT"
    seq = dna(random.Random(1), 37)
    rows_ = spark.createDataFrame([("g", "r", seq)], "name string, seq_id string, seq string")
    got = H.windows(rows_, 5, step=8).orderBy("pos").collect()
    assert [(r.pos, r.kmer) for r in got] == [(i, seq[i : i + 5]) for i in range(33)]


def test_search_against_brute_force(spark):
    rng = random.Random(3)
    oligo = dna(rng, 20)
    mutate = lambda s, at: "".join(("A" if c != "A" else "C") if i in at else c for i, c in enumerate(s))
    text = dna(rng, 50) + oligo + dna(rng, 30) + mutate(oligo, {3, 15}) + dna(rng, 30) + mutate(oligo, {1, 8, 15}) + dna(rng, 20) + rc(oligo) + dna(rng, 10)
    seqs = spark.createDataFrame([("g", "r", text)], "name string, seq_id string, seq string")
    want = set()
    for strand, o in (("+", oligo), ("-", rc(oligo))):
        for i in range(len(text) - 19):
            m = sum(a != b for a, b in zip(o, text[i : i + 20], strict=True))
            if m <= 2:
                want.add((strand, i, m))
    got = H.search_oligos(spark.createDataFrame([("o", oligo)], "oligo string, seq string"), seqs, 0.1)
    assert set(rows(got, "strand", "pos", "mismatches")) == want and len(want) >= 3


def test_search_primers_pairs(spark):
    rng = random.Random(5)
    f, r = dna(rng, 20), dna(rng, 20)
    text = dna(rng, 11) + f + dna(rng, 60) + rc(r) + dna(rng, 200) + r + dna(rng, 40) + rc(f) + dna(rng, 9)
    seqs = spark.createDataFrame([("g", "s", text)], "name string, seq_id string, seq string")
    p = spark.createDataFrame([("p", f, r)], "name string, forward_seq string, reverse_seq string")
    got = rows(H.search_primers(p, seqs, 0.1, 150), "fwd_oligo", "fwd_start", "rev_end", "length")
    assert got == [("fwd", 12, 111, 100), ("rev", 312, 391, 80)]


def test_design_against_brute_force(spark):
    rng = random.Random(7)
    text = dna(rng, 260)
    d = D.Design(num_return=5, size_min=18, size_opt=20, size_max=19, tm_min=40, tm_max=70, product_min=50, product_opt=60, product_max=70)
    s = spark.createDataFrame([("g", "r", text)], "name string, seq_id string, seq string")
    got = [(r.forward_start, r.forward_seq, r.reverse_start, r.reverse_seq, r.penalty) for r in D.design_primer_pairs(s, d).orderBy("name").collect()]
    tm = lambda x: 64.9 + 41.0 * (sum(c in "GC" for c in x) - 16.4) / len(x)
    ok = lambda x: 30 <= 100 * sum(c in "GC" for c in x) / len(x) <= 80 and 40 <= tm(x) <= 70 and not any(b * 4 in x for b in "ACGT")
    arms = [(i, text[i : i + k]) for k in (18, 19) for i in range(len(text) - k + 1) if ok(text[i : i + k])]
    pairs = []
    for i, a in arms:
        for j, b in arms:
            size = j + len(b) - i
            if 50 <= size <= 70 and j >= i + len(a):
                pairs.append((round(sum(abs(len(x) - 20) + abs(tm(x) - 59) for x in (a, b)) + abs(size - 60), 6), i, j, len(a), len(b), a, b))
    want = [(i + 1, a, j + 1, rc(b), p) for p, i, j, _, _, a, b in sorted(pairs)[:5]]
    assert got == want


def test_offtarget_both_strands(spark):
    rng = random.Random(9)
    core = dna(rng, 16)
    db = spark.createDataFrame([(dna(rng, 40) + core + dna(rng, 40),)], "seq string")
    q = spark.createDataFrame([("hit", dna(rng, 2) + core), ("rev", rc(core)), ("miss", core[:15] + ("A" if core[15] != "A" else "C"))], "name string, seq string")
    assert rows(H.offtarget_hits(q, db, 15), "name") == [("hit",), ("rev",)]


def test_conserved_blocks(spark):
    rng = random.Random(11)
    shared = dna(rng, 120)
    changed = shared[:60] + ("A" if shared[60] != "A" else "C") + shared[61:]
    s = spark.createDataFrame([("a", "a1", dna(rng, 30) + shared + dna(rng, 50)), ("b", "b1", dna(rng, 70) + changed)], "name string, seq_id string, seq string")
    got = rows(H.conserved_blocks(s).where("query = 'a'"), "start", "end", "sstart", "sim_errors")
    assert [(x[0], x[2], x[3]) for x in got] == [(30, 70, 1)] and got[0][1] >= 150


def test_amplicons_and_diversity(spark):
    seqs = spark.createDataFrame([("t", "A" * 5 + "C" * 60 + "G" * 5)], "name string, seq string")
    amps = spark.createDataFrame([("p", "t", 1, "F", 6, 65), ("q", "t", 2, "X", 6, 65), ("p", "t", 3, "F", 6, 55)], "primer_name string, target string, idx int, fwd_seq string, fwd_start int, rev_end int")
    pairs = spark.createDataFrame([("p", "F"), ("q", "F")], "name string, forward_seq string")
    got = rows(V.extract_amplicons(amps, pairs, seqs), "amplicon_name", "seq")
    assert got == [("p_t_1", "C" * 60), ("q_t_2", "G" * 60)]
    a = spark.createDataFrame([("p", "1", "AAAA"), ("p", "2", "AAAC"), ("p", "3", "AAAA"), ("s", "1", "AC")], "primer string, amplicon_name string, seq string")
    st = {r.primer: r for r in V.pairwise_distance_stats(a).collect()}
    assert abs(st["p"].dist_mean - 1 / 6) < 1e-12 and st["p"].n_unique == 2 and st["p"].n_nonunique == 1
    assert abs(st["p"].shannon - 0.6365141682948128) < 1e-9 and st["s"].shannon == 0 and st["s"].dist_mean == 0 and st["s"].evenness == 0
    with pytest.raises(Exception, match="differ in length"):
        V.pair_distances(spark.createDataFrame([("p", "1", "A"), ("p", "2", "AC")], a.schema)).collect()
    assert V.pair_distances(spark.createDataFrame([("p", "1", "A"), ("p", "2", "AC")], a.schema), aligned=False).first()["dist"] == 0.5


def test_aligned_distances(monkeypatch):
    from cohortmark.operators import align

    monkeypatch.setattr(align, "CELLS", 40)
    rng = random.Random(3)
    pairs = [tuple("".join(rng.choice("ACG-é\U00020000") for _ in range(n)) for _ in "xy") for n in (1, 30, 2, 90, 7, 7, 40, 1) * 5]
    assert align.aligned_distances(*map(list, zip(*pairs, strict=True))).tolist() == [1.0 - sum(a == b for a, b in zip(x, y, strict=True)) / len(x) for x, y in pairs]
    assert align.aligned_distances([], []).tolist() == []
    for y in ("AC", None):
        with pytest.raises(ValueError, match="differ in length"):
            align.aligned_distances(["A", "G"], ["A", y])


def test_scatter_computes_its_stats_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    stats = spark.createDataFrame([("a", 2, 0, 0.1), ("b", 3, 1, 0.3)], "primer string, n_unique long, n_nonunique long, dist_mean double").mapInArrow(counted, "primer string, n_unique long, n_nonunique long, dist_mean double")
    got = rows(V.marker_scatter(stats), "label", "x", "y", "x_min", "y_min")
    assert got == [("a", 0, 0.1, -0.1, -0.01), ("b", 1, 0.3, -0.1, -0.01)] and seen.value == 2


def test_pareto(spark):
    s = spark.createDataFrame([("a", 0, 0.1), ("b", 1, 0.3), ("c", 1, 0.2), ("d", 2, 0.3), ("e", 0, 0.1)], "primer string, n_nonunique int, dist_mean double")
    assert rows(V.marker_pareto(s), "primer") == [("a",), ("b",), ("e",)]


def test_argument_checks(spark):
    assert M.check_filter_mode(alnvar="x") == "alnvar"
    with pytest.raises(ValueError):
        M.check_filter_mode(prodigal=True, alnvar="x")
    with pytest.raises(ValueError):
        M.check_manifest_format("x.tab", json_only=True)
    with pytest.raises(ValueError):
        M.check_manifest_format("x.csv")
    with pytest.raises(ValueError):
        M.output_name("nothing", F.lit("x"))
    man = spark.createDataFrame([("a", ["x"])], "name string, groups array<string>")
    with pytest.raises(ValueError):
        M.group_members(man, "nope")
    assert M.pairwise_permutations(man).count() == 0 and M.lookup(man, "a").count() == 1


def test_conserved_blocks_of_chosen_queries(spark, monkeypatch):
    rng = random.Random(12)
    shared, twice = dna(rng, 150), dna(rng, 80)
    others = [(f"d{i}", f"d{i}", dna(rng, 20 + i) + shared + (twice if i % 2 else twice + dna(rng, 9) + twice) + dna(rng, 40)) for i in range(12)]
    both = [("b1", "b1", shared[10:140] + twice), ("b2", "b2", dna(rng, 100))]
    df = lambda x: spark.createDataFrame(x, "name string, seq_id string, seq string")
    cols = ("query", "subject", "start", "end", "sstart", "sim_errors")
    whole = rows(H.conserved_blocks(df(both + others)).where("query like 'b%'"), *cols)
    kept, write = [], H.stored
    monkeypatch.setattr(H, "stored", lambda x, name: kept.append(write(x, name)) or kept[-1])
    assert rows(H.conserved_blocks(df(both + others), queries=df(both)), *cols) == whole and len(whole) >= 12
    assert kept[0].where("name like 'd%'").join(kept[0].where("name like 'b%'"), "kmer", "left_anti").isEmpty()  # words that no query has are not counted


def test_edit_distances_of_pairs_leave_the_row_interpreter(spark):
    """A table of 100 by 100 cells for each pair is not worked through a cell at a time; nulls, empty and other letters count as Spark's levenshtein counts them."""
    from pyspark.sql import functions as F

    from cohortmark.operators import diversity

    data = [("p", "a", "ACGTACGT"), ("p", "b", "CGTACG"), ("p", "c", ""), ("p", "d", None), ("p", "e", "é😀"), ("q", "f", ""), ("q", "g", ""), (None, "h", "A")]
    df = spark.createDataFrame(data, "primer string, amplicon_name string, seq string")
    seqs = df.select("amplicon_name", "seq")
    got = diversity.pair_distances(df, aligned=False)
    assert "levenshtein" not in got._jdf.queryExecution().optimizedPlan().toString()
    both = got.join(seqs.toDF("a", "x"), "a").join(seqs.toDF("b", "y"), "b").withColumn("want", F.levenshtein("x", "y") / F.greatest(F.length("x"), F.length("y"), F.lit(1)))
    assert got.count() == 11 and both.where(~F.col("dist").eqNullSafe(F.col("want"))).count() == 0
    stats = {r.primer: r.dist_max for r in diversity.pairwise_distance_stats(df, aligned=False).collect()}
    assert stats["p"] == 1.0 and stats["q"] == 0.0
