"""Readers and writers on small files."""

import json
import random

import pytest
from frames import rows

from cohortmark.sources import readers as R
from cohortmark.sources import writers as W


def put(path, text):
    path.write_text(text)
    return str(path)


def test_manifest_tab(spark, tmp_path):
    p = put(tmp_path / "m.tab", "# note\n\na\tx, y\tin/a.fasta\t-\nb\tx\tin/b.fna\ta.gff\na\tz\tin/a2.fasta\n")
    got = R.scan_manifest_tab(spark, p)
    assert rows(got, "name", "groups", "features", "filestem") == [("a", ["z"], None, "a2"), ("b", ["x"], "a.gff", "b")]
    bad = put(tmp_path / "bad.tab", "a\tx\n")
    with pytest.raises(Exception, match="3 or 4 columns"):
        R.scan_manifest_tab(spark, bad).collect()


def test_manifest_json_and_convert(spark, tmp_path):
    one = {"name": "a", "groups": ["y", "x"], "seqfile": "s/a.fas", "features": None, "primers": None, "target_amplicons": None}
    p = put(tmp_path / "m.json", json.dumps([one]))
    assert rows(R.scan_manifest_json(spark, p), "name", "groups", "primersearch", "filestem") == [("a", ["x", "y"], None, "a")]
    out = str(tmp_path / "out.tab")
    assert W.convert_manifest(spark, p, out) == "tab"
    assert rows(R.scan_manifest_tab(spark, out), "name", "groups", "seqfile") == [("a", ["x", "y"], "s/a.fas")]
    assert W.convert_manifest(spark, put(tmp_path / "n.conf", "a\tx\ts.fas\n"), str(tmp_path / "n2")) == "json"
    del one["primers"]
    with pytest.raises(ValueError, match="primers"):
        R.scan_manifest_json(spark, put(tmp_path / "b.json", json.dumps([one])))


@pytest.mark.parametrize("size", [7, 10_000])
def test_fasta_tiles_of_split_files(spark, tmp_path, size):
    rng = random.Random(size)
    own = ["".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 5, 40, 90]))) for _ in range(60)]
    text = "".join(f">r{i} about\r\n" + "".join(s[k : k + 9] + "\n" for k in range(0, len(s), 9)) + "\n" * (i % 2) for i, s in enumerate(own))
    p = put(tmp_path / "g.fasta", text)
    put(tmp_path / "h.fasta", ">one\nAC\nGT\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = R.scan_fasta_tiles(spark, [p, str(tmp_path / "h.fasta")], size).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert max(len(r.seq) for r in got) <= size
    whole = {}
    for r in sorted(got, key=lambda r: r.tile):
        whole[r.name, r.ord, r.seq_id] = whole.get((r.name, r.ord, r.seq_id), "") + r.seq
    assert whole == {**{("g", i, f"r{i}"): s for i, s in enumerate(own)}, ("h", 0, "one"): "ACGT"}


def test_fasta_split_files(spark, tmp_path):
    text = "".join(f">r{i} about {i}\nACGT\nAC{'G' * (i % 7)}\n" for i in range(300))
    p = put(tmp_path / "g.fasta", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = R.scan_fasta(spark, p).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.seq_id, r.description, r.seq) for r in got] == [(f"r{i}", f"r{i} about {i}", "ACGTAC" + "G" * (i % 7)) for i in range(300)]
    assert {r.name for r in got} == {"g"}
    assert [r.ord for r in got] == list(range(300))
    with pytest.raises(Exception, match="differ in length"):
        R.scan_alignment_fasta(spark, p).collect()


REPORT = """# EPRIMER3 PRIMERS x
# given_1
1    PRODUCT SIZE: 100
     FORWARD PRIMER  11    20   59.01  50.00  GATAAACCTGCCGATCTGGT
     REVERSE PRIMER  91    20   59.00  45.00  GAATTTCTGCAACAGGCTCA
     INTERNAL OLIGO  0          0    0.00  0.00


# given_2
2    PRODUCT SIZE: 101
     FORWARD PRIMER  12    20   59.02  45.00  TTTCTCGTGATAAGCGATGC
     REVERSE PRIMER  92    21   59.00  55.00  GTCCCACAACCCTCACTTCTA
     INTERNAL OLIGO  40         20   60.50  50.00  ACGTACGTACGTACGTACGT
"""


def test_eprimer3(spark, tmp_path):
    p = put(tmp_path / "g.eprimer3", REPORT)
    assert rows(R.scan_primers(spark, p), "name", "size", "forward_start", "reverse_length", "internal_seq", "internal_start", "forward_tm") == [("g_primer_00001", 100, 11, 20, "", 0, 59.01), ("g_primer_00002", 101, 12, 21, "ACGTACGTACGTACGTACGT", 40, 59.02)]
    assert rows(R.scan_primers(spark, p, noname=True), "name") == [("given_1",), ("given_2",)]
    with pytest.raises(ValueError):
        R.scan_primers(spark, p, "other")


def test_primer3(spark, tmp_path):
    put(tmp_path / "g.primer3", "SEQUENCE_ID=g\nPRIMER_PAIR_0_PENALTY=0.1\nPRIMER_LEFT_0=10,20\nPRIMER_RIGHT_0=110,21\nPRIMER_LEFT_0_SEQUENCE=ACGT\nPRIMER_RIGHT_0_SEQUENCE=TTTT\nPRIMER_LEFT_0_TM=59.1\nPRIMER_RIGHT_0_TM=59.2\nPRIMER_LEFT_0_GC_PERCENT=50.0\nPRIMER_RIGHT_0_GC_PERCENT=45.0\nPRIMER_PAIR_0_PRODUCT_SIZE=101\n=\n")
    put(tmp_path / "none.primer3", "SEQUENCE_ID=n\nPRIMER_PAIR_NUM_RETURNED=0\n=\n")
    got = R.scan_primers(spark, str(tmp_path / "*.primer3"), "p3")
    assert rows(got, "name", "size", "forward_start", "forward_length", "reverse_start", "reverse_seq", "reverse_gc") == [("g_primer_00001", 101, 10, 20, 110, "TTTT", 45.0)]


def test_primersearch_report(spark, tmp_path):
    text = "\nPrimer name p1\nAmplimer 1\n\tSequence: S1  \n\tsome words\n\tACGTACGTAC hits forward strand at 11 with 0 mismatches\n\tTTTTTACGTA hits reverse strand at [391] with 1 mismatches\n\tAmplimer length: 100 bp\nAmplimer 2\n\tSequence: S1  \n\t\n\tACGTACGTAC hits forward strand at 200 with 1 mismatches\n\tTTTTTACGTA hits reverse strand at [5] with 0 mismatches\n\tAmplimer length: 297 bp\n\nPrimer name p2\n"
    put(tmp_path / "q_ps_t.primersearch", text)
    lengths = spark.createDataFrame([("t", 500)], "target string, target_length long")
    got = rows(R.scan_primersearch_report(spark, str(tmp_path / "*.primersearch"), lengths), "query", "target", "primer_name", "idx", "fwd_start", "fwd_end", "rev_start", "rev_end", "length", "rev_mismatches")
    assert got == [("q", "t", "p1", 1, 11, 21, 100, 110, 100, 1), ("q", "t", "p1", 2, 200, 210, 486, 496, 297, 0)]


def test_primersearch_report_is_read_in_splits(spark, tmp_path):
    hit = lambda n, k: f"Amplimer {k + 1}\n\tSequence: S{n}  \n\t\n\t{'ACGT' * (1 + n % 3)} hits forward strand at {n + k} with {n % 2} mismatches\n\tTTTA hits reverse strand at [{n}] with 3 mismatches\n\tAmplimer length: {90 + k} bp\n"
    for t in ("t", "u.v"):
        put(tmp_path / f"q_ps_{t}.primersearch", "Amplimer 1\n of no primer\n" + "".join(f"\nPrimer name p{n}\n" + "".join(hit(n, k) for k in range(n % 4)) for n in range(80)))
    lengths = spark.createDataFrame([("t", 500), ("u.v", 600)], "target string, target_length long")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = R.scan_primersearch_report(spark, str(tmp_path / "*.primersearch"), lengths)
        assert got.rdd.getNumPartitions() > 10
        found = rows(got, "query", "target", "primer_name", "idx", "amplimer", "sequence", "fwd_seq", "fwd_start", "fwd_end", "fwd_mismatches", "rev_seq", "rev_pos", "rev_mismatches", "rev_start", "rev_end", "length")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    long = lambda n: 4 * (1 + n % 3)
    want = [("q", t, f"p{n}", k + 1, f"Amplimer {k + 1}", f"S{n}", "ACGT" * (1 + n % 3), n + k, n + k + long(n), n % 2, "TTTA", n, 3, size - n + 1 - 4, size - n + 1, 90 + k) for t, size in (("t", 500), ("u.v", 600)) for n in range(80) for k in range(n % 4)]
    assert found == sorted(want, key=repr)


def test_amplicon_json_and_index(spark, tmp_path):
    a = {"_fwd": ["AC", 1, 3], "_rev": ["GT", 50, 52], "_len": 52, "_name": "Amplimer 1", "_seqname": "S", "primer_name": "p", "target": "x.fas", "target_fasta_id": "S"}
    amps = R.scan_target_amplicons_json(spark, put(tmp_path / "a.json", json.dumps({"t1": [a], "t2": []})))
    assert rows(amps, "target", "fwd.start", "rev.end", "length") == [("t1", 1, 52, 52)]
    W.write_target_amplicons(amps, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out/bed")).collect()] == ["S\t1\t52\tp"]
    idx = R.scan_primersearch_index(spark, put(tmp_path / "i.json", json.dumps({"query": "q", "primers": "p", "t1": "r1"})))
    assert rows(idx, "target", "report") == [("t1", "r1")]


DELTA = "a/ref.fas b/qry.fas\nNUCMER\n>r1 q1 100 200\n1 50 1 50 5 5 0\n-3\n4\n0\n60 60 60 60 1 1 0\n0\n>r1 q2 100 90\n10 90 1 81 0 0 0\n0\n"


def test_delta(spark, tmp_path):
    p = put(tmp_path / "x.delta", DELTA)
    full = R.scan_delta_full(spark, p)
    assert rows(full, "ref", "qry", "qry_length", "ref_start", "ref_end", "sim_errors", "indels", "program") == [("r1", "q1", 200, 1, 50, 5, [-3, 4], "NUCMER"), ("r1", "q1", 200, 60, 60, 1, [], "NUCMER"), ("r1", "q2", 90, 10, 90, 0, [], "NUCMER")]
    assert rows(R.scan_delta_intervals(spark, p, 0, 0.05), "query", "subject", "start", "end") == [("ref", "qry", 1, 50)]
    assert R.scan_delta_intervals(spark, p).count() == 3
    text = "\n".join(r.value for r in W.delta_text(full).orderBy("row_no").collect()) + "\n"
    assert text == DELTA.split("NUCMER\n")[1]
    assert R.delta_equal(full, full).first()["equal"] and not R.delta_equal(full, full.limit(2)).first()["equal"]


def test_delta_of_split_files(spark, tmp_path):
    def put_file(f, n):
        text = f"a/r{f}.fas b/q.fas\nNUCMER\n"
        for h in range(n):
            text += f">r{h} q{h} 1000 2000\n" + "".join(f"{i + 1} {i + 50} {h + 1} {h + 50} 5 5 0\n" + "".join(f"{k + 1}\n" for k in range(i % 4)) + "0\n" for i in range(h % 5))
        put(tmp_path / f"f{f}.delta", text)
        return [(f"r{f}", f"r{h}", i + 1, h + 1, list(range(1, i % 4 + 1))) for h in range(n) for i in range(h % 5)]

    want = put_file(0, 60) + put_file(1, 1) + put_file(2, 9)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        got = R.scan_delta_full(spark, str(tmp_path / "*.delta"))
        assert rows(got, "query", "ref", "ref_start", "qry_start", "indels") == sorted(want, key=repr)
        assert R.scan_delta_intervals(spark, str(tmp_path / "*.delta")).where("query = 'r0'").count() == sum(x[0] == "r0" for x in want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_features_and_tables(spark, tmp_path):
    g = put(tmp_path / "x.gff", "##gff\nc\tp\tCDS\t11\t20\t.\t+\t0\tid\n")
    b = put(tmp_path / "x.bed", "c\t10\t20\tn\n")
    assert rows(R.scan_features(spark, g), "chrom", "start", "end") == rows(R.scan_features(spark, b), "chrom", "start", "end") == [("c", 10, 20)]
    t = put(tmp_path / "d.tab", "primer\tdist_mean\tunique\np\t0.1\t3\n")
    assert rows(R.scan_distance_table(spark, t), "primer", "dist_mean", "unique") == [("p", 0.1, 3)]
    h = put(tmp_path / "x.blasttab", "p_fwd\ts\t100.0\t18\t0\t0\t1\t18\t5\t22\t1e-3\t30.1\n")
    assert rows(R.scan_blast_hits(spark, h), "query", "length", "send") == [("p_fwd", 18, 22)]


def test_primer_writers(spark, tmp_path):
    p = R.scan_primers(spark, put(tmp_path / "g.eprimer3", REPORT), noname=True)
    for fmt, want in (("tsv", 4), ("fasta", 10), ("bed", 2)):
        W.write_primers(p.withColumnRenamed("source", "source_id") if fmt == "bed" else p, str(tmp_path / fmt), fmt)
        assert spark.read.text(str(tmp_path / fmt)).count() == want
    W.write_primers(p, str(tmp_path / "ep3"), "ep3")
    again = R.scan_primers(spark, str(tmp_path / "ep3" / "*"), noname=True)
    cols = [c for c in p.columns if c not in ("source", "sourcename")]
    assert rows(again, *cols) == rows(p, *cols)
    W.write_primers(p, str(tmp_path / "json"), "json")
    assert rows(spark.read.schema(R.PRIMER_SCHEMA).json(str(tmp_path / "json")), *cols) == rows(p, *cols)


def test_result_writers(spark, tmp_path):
    groups = spark.createDataFrame([("x",), ("y",)], "group string")
    found = spark.createDataFrame([("x", "given_1")], "group string, primer string")
    p = R.scan_primers(spark, put(tmp_path / "g.eprimer3", REPORT), noname=True)
    W.write_classification(groups, found, p, str(tmp_path / "c"))
    got = spark.read.csv(str(tmp_path / "c/summary"), sep="\t", header=True)
    assert rows(got, "Group", "NumPrimers") == [("x", "1"), ("y", "0")]
    a = spark.createDataFrame([("p", "p_t_1", "ACGT")], "primer string, amplicon_name string, seq string")
    W.write_amplicon_fasta(a, str(tmp_path / "f"))
    assert rows(spark.read.text(str(tmp_path / "f")), "value") == [(">p_t_1 Predicted diagnostic amplicon",), ("ACGT",)]
    s = spark.createDataFrame([("s1", "ACGT")], "seq_id string, seq string")
    W.write_bedgenome(s, str(tmp_path / "b"))
    assert rows(spark.read.text(str(tmp_path / "b")), "value") == [("s1\t4",)]
    st = spark.createDataFrame([("p", 0.12345, 0.0, 0.0, 1.0, 2, 1, 0.6931, 1.0)], "primer string, dist_mean double, dist_sd double, dist_min double, dist_max double, n_unique long, n_nonunique long, shannon double, evenness double")
    W.write_distance_summary(st, str(tmp_path / "d"))
    assert rows(spark.read.text(str(tmp_path / "d")), "value")[1] == ("primer\tdist_mean\tdist_sd\tdist_min\tdist_max\tunique\tnonunique\tshannon_index\tshannon_evenness",)


def test_design_files_are_read_in_splits(spark, tmp_path):
    """No row holds a file, and no pair looks through the others."""
    n = 60
    arm = lambda label, i, seq: f"     {label}  {i:<10d} 20  59.50  50.00  {seq}"
    ep3 = "\n".join("\n".join([f"# p{i}", f"{i + 1:<4d} PRODUCT SIZE: {100 + i}", arm("FORWARD PRIMER", i, "ACGT"), arm("REVERSE PRIMER", i + 5, "TTTT"), "\n"]) for i in range(n))
    p3 = "SEQUENCE_ID=g\n" + "".join(f"PRIMER_PAIR_{i}_PENALTY=0.5\nPRIMER_LEFT_{i}={i},20\nPRIMER_RIGHT_{i}={i + 5},20\nPRIMER_LEFT_{i}_SEQUENCE=ACGT\nPRIMER_PAIR_{i}_PRODUCT_SIZE={100 + i}\n" for i in range(n)) + "=\nPRIMER_PAIR_99_PENALTY=1\n=\n"
    put(tmp_path / "g.eprimer3", ep3)
    put(tmp_path / "g.primer3", p3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for fmt, noname, name in (("eprimer3", True, "p{0}"), ("eprimer3", False, "g_primer_{1:05d}"), ("primer3", False, "g_primer_{1:05d}")):
            found = R.scan_primers(spark, str(tmp_path / f"*.{fmt}"), fmt, noname)
            assert rows(found, "size", "name", "forward_start") == [(100 + i, name.format(i, i + 1), i) for i in range(n)]
            assert spark.read.text(str(tmp_path / f"*.{fmt}")).rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_large_design_files_by_line(spark, tmp_path, monkeypatch):
    put(tmp_path / "g.eprimer3", "# p\n1    PRODUCT SIZE: 100\n")
    put(tmp_path / "g.primer3", "PRIMER_PAIR_0_PENALTY=0.5\n=\n")
    monkeypatch.setattr(R, "_whole", None)
    assert R.scan_primers_eprimer3(spark, str(tmp_path / "*.eprimer3"), True).count() == R.scan_primers_primer3(spark, str(tmp_path / "*.primer3")).count() == 1


def test_many_small_files_are_written_by_many_tasks(spark, tmp_path):
    import glob
    import re

    from cohortmark.operators import design
    from cohortmark.sources import writers

    path = str(tmp_path / "boulder")
    names = spark.createDataFrame([(f"g{i}",) for i in range(40)], "name string")
    writers.write_boulder_input(design.boulder_input(names), path)
    found = glob.glob(f"{path}/name=*/part-*.txt")
    assert len(found) == 40 and len({re.search(r"/part-(\d+)", x)[1] for x in found}) > 2
    read = spark.read.text(path).select("name", "value")
    assert read.count() == writers.boulder_lines(design.boulder_input(names)).count() and read.select("name").distinct().count() == 40
    writers.write_boulder_input(design.boulder_input(names.where("name < 'g2'")), path)  # in place of what was there
    assert spark.read.text(path).select("name").distinct().count() == names.where("name < 'g2'").count()


def test_fasta_tiles_of_a_record_over_many_splits(spark, tmp_path):
    """No line is sorted or joined: a split's lines become stretches, and only a row for each split goes on."""
    lines = lambda s: "".join(s[k : k + 10] + "\n" for k in range(0, len(s), 10))
    long = "".join(random.Random(3).choice("ACGTé") for _ in range(995))
    p = put(tmp_path / "g.fasta", "ACGT\nAC\n>a first one\n" + lines(long) + ">empty\n>b\nA C\nGT \n>a first one\n" + lines(long[::-1]) + "> \n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "120")
    try:
        found = R.scan_fasta_tiles(spark, p, 100)
        got = found.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = {}
    for r in sorted(got, key=lambda r: r.tile):
        whole[r.ord, r.seq_id, r.description] = whole.get((r.ord, r.seq_id, r.description), "") + r.seq
    assert whole == {(0, "a", "a first one"): long, (1, "empty", "empty"): "", (2, "b", "b"): "ACGT", (3, "a", "a first one"): long[::-1], (4, "", ""): ""}
    assert all(len(r.seq) == min(100, 995 - 100 * r.tile) for r in got if r.ord in (0, 3))
    plan = found._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "monotonically_increasing_id" not in plan
