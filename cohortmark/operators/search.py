"""Sequence matching as equi-joins on k-mers: mismatch-tolerant search, off-target screening, conserved blocks."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmark.functions.sequence import hamming, reverse_complement

from . import places
from .sequences import pieces, sized
from .storage import stored

#: Bases of the pieces that long records are cut into, in two steps.
CHUNK, LARGE = 200, 10_000


def windows(sequences: DataFrame, k: int, step: int = CHUNK) -> DataFrame:
    """(name, seq_id, pos, kmer): every window of k bases without N; records go through overlapping pieces."""
    rows = placed_windows(pieces(sequences, 0, k - 1, step, max(step, LARGE)), k)
    return rows.select("name", "seq_id", (F.col("offset") + F.col("p")).alias("pos"), "kmer")


def windows_among(sequences: DataFrame, k: int, words: DataFrame) -> DataFrame:
    """(name, seq_id, pos, kmer): the windows of k bases whose ``kmer`` is among ``words``, which are different and have no N. Few words are sent to the text."""
    known = places.few(words.select("kmer"), SENT_WORDS)
    if known is None:
        return windows(sequences, k).join(words.hint("merge"), "kmer", "left_semi").select("name", "seq_id", "pos", "kmer")
    rows = places.standing(pieces(sequences, 0, k - 1, LARGE, LARGE), known)
    rows = rows.select("name", "seq_id", (F.col("start") + F.col("p")).alias("pos"), F.col("seq").alias("kmer"))
    return rows.join(F.broadcast(words), "kmer", "left_semi").select("name", "seq_id", "pos", "kmer")


def word_counts(sequences: DataFrame, k: int) -> DataFrame:
    """(kmer, n): how often each word of k bases without N stands in the sequences."""
    if k > places.COUNTED:
        return windows(sequences, k).groupBy("kmer").agg(F.count("*").alias("n"))
    rows = sequences.select("name", "seq_id", "seq")
    return places.counted(pieces(rows, 0, k - 1, LARGE, LARGE), k).groupBy("kmer").agg(F.sum("n").alias("n"))


def placed_windows(rows: DataFrame, k: int) -> DataFrame:
    """``pieces`` with ``p`` and ``kmer`` of each window without N that begins among a piece's own bases."""
    last = F.least(F.col("lead") + F.col("own"), F.length("seq") - k + 1) - 1
    rows = rows.where(last >= F.col("lead")).withColumn("p", F.explode(F.sequence(F.col("lead"), last)))
    return rows.withColumn("kmer", F.substring(F.col("seq"), F.col("p") + 1, F.lit(k))).where(~F.col("kmer").contains("N"))


#: Candidates that a place of the text may have by chance, all oligos together, before seeds are made longer and laxer.
PER_PLACE = 0.02
#: Most words that an oligo's seeds are written out as, and most words that are sent to all tasks.
NEAR_WORDS, SENT_WORDS = 4096, 1_000_000


@dataclass(frozen=True)
class Seeding:
    """How oligos of ``n`` bases with ``m`` mismatches are seeded: stretches of ``k`` bases, the i-th of which may differ in ``lax[i]`` places.

    ``words`` are written out for each oligo; ``candidates`` stand at a place of a random text by chance, for each oligo.
    """

    n: int
    m: int
    k: int
    lax: tuple[int, ...]

    @property
    def words(self) -> int:
        return sum(math.comb(self.k, i) * 4**i for j in self.lax for i in range(j + 1))

    @property
    def candidates(self) -> float:
        return sum(math.comb(self.k, i) * 3**i for j in self.lax for i in range(j + 1)) / 4**self.k


def seeding(n: int, m: int, oligos: int, per_place: float = PER_PLACE, sent_words: int = SENT_WORDS, most_words: int = NEAR_WORDS) -> Seeding:
    """The seeding of ``oligos`` oligos (strands counted) with the fewest words that leaves a place ``per_place`` candidates. If all such have more than ``sent_words``
    words, one with fewer words is taken that leaves a place less than one candidate, as a candidate is cheaper than a shuffle of the text; or else the one with the fewest candidates.

    Of p stretches that may differ in j1, j2, ... places, m mismatches leave one within its bound if (j1 + 1) + (j2 + 1) + ... = m + 1. So m + 1 short stretches
    must match exactly, or fewer and longer ones nearly: a stretch of ten bases with a mismatch has 31 words of bases among 4 ** 10, one of six bases one among 4 ** 6.
    """
    found = []
    for p in range(m + 1, 0, -1):
        more, extra = divmod(m + 1, p)
        found.append(Seeding(n, m, n // p, tuple(more - (i >= extra) for i in range(p))))
    found = [x for i, x in enumerate(found) if i == 0 or x.words <= most_words]
    good = [x for x in found if x.candidates * oligos <= per_place]
    best = min(good, key=lambda x: x.words) if good else min(found, key=lambda x: x.candidates)
    light = [x for x in found if x.words * oligos <= sent_words and x.candidates * oligos < 1]
    return best if best.words * oligos <= sent_words or not light else min(light, key=lambda x: x.candidates)


def near_words(word: Column, lax: int) -> Column:
    """All words of A, C, G, T and N that differ from ``word`` in at most ``lax`` places."""
    found = F.array(word)

    def changed(w: Column) -> Column:
        at = lambda i: F.transform(F.array(*map(F.lit, "ACGTN")), lambda b: F.concat(F.substring(w, F.lit(1), i - 1), b, F.substring(w, i + 1, F.length(w))))
        return F.flatten(F.transform(F.sequence(F.lit(1), F.length(w)), at))

    for _ in range(lax):
        found = F.array_distinct(F.flatten(F.transform(found, changed)))
    return found


def seed_words(both: DataFrame, plan: list[Seeding]) -> DataFrame:
    """(oligo, strand, oseq, n, m, at, word): the words of each oligo's seeds; letters that are no base are N in them."""
    out = None
    for x in plan:
        rows, base = both.where((F.col("n") == x.n) & (F.col("m") == x.m)), F.regexp_replace("oseq", "[^ACGT]", "N")
        parts = [F.struct(F.lit(i * x.k).alias("at"), near_words(F.substring(base, i * x.k + 1, x.k), j).alias("words")) for i, j in enumerate(x.lax)]
        rows = rows.withColumn("x", F.explode(F.array(*parts))).withColumn("word", F.explode("x.words")).select("oligo", "strand", "oseq", "n", "m", "x.at", "word")
        out = rows if out is None else out.union(rows)
    return out


def search_oligos(oligos: DataFrame, sequences: DataFrame, mismatch: float = 0.1, per_place: float = PER_PLACE, sent_words: int = SENT_WORDS) -> DataFrame:
    """(oligo, strand, name, seq_id, pos, n, mismatches): where each oligo (oligo, seq) lies with at most int(mismatch * length) mismatches.

    Seeds (``seeding``) are written out as words and join the words at every place of the text, in one pass for oligos of all lengths; candidates are compared
    in full. The more oligos there are, the longer and laxer their seeds, so candidates do not grow with them. Few words are sent to the text; many meet it in a
    shuffle, where a place takes only the bases with it that an oligo may cover. Both strands; pos counts from 0 on the forward strand. Letters match
    themselves; an oligo with N needs a stretch, of m + 1 equal ones, that matches without N. An empty or null oligo or text has no place.
    """
    plus = oligos.select("oligo", F.lit("+").alias("strand"), F.upper("seq").alias("oseq")).where("oseq <> ''")
    both = plus.union(plus.select("oligo", F.lit("-"), reverse_complement(F.col("oseq"))))
    both = both.withColumn("n", F.length("oseq")).withColumn("m", F.floor(F.lit(mismatch) * F.col("n") + 1e-9).cast("int"))
    counts = sorted(tuple(r) for r in both.groupBy("n", "m").count().collect())  # a handful of lengths
    if not counts:
        return oligos.select("oligo").limit(0).selectExpr("oligo", "'' strand", "'' name", "'' seq_id", "0 pos", "0 n", "0 mismatches")
    total = sum(c for _, _, c in counts)
    plan = [seeding(n, m, total, per_place, sent_words) for n, m, _ in counts]
    longest, sizes = max(n for n, _, _ in counts), sorted({x.k for x in plan})
    few = sum(x.words * c for x, (_, _, c) in zip(plan, counts, strict=True)) <= sent_words

    texts, seeds = sequences.select("name", "seq_id", F.upper("seq").alias("seq")), seed_words(both, plan)
    known = places.few(seeds.select("word").distinct(), sent_words) if few and sizes[0] else None
    if known is not None:  # only the places at which a seed stands become rows
        rows = pieces(texts, longest, longest + sizes[-1], max(LARGE, longest), max(LARGE, longest))
        rows = places.standing(rows, known, longest, longest, "N")
        rows = rows.withColumn("word", F.regexp_replace(F.expr("substring(seq, p + 1, k)"), "[^ACGT]", "N"))
    else:
        rows = pieces(texts, longest, longest + sizes[-1], max(CHUNK, longest), max(LARGE, longest))
        last = F.least(F.col("lead") + F.col("own"), F.length("seq") - sizes[0] + 1) - 1
        rows = rows.where(last >= F.col("lead")).withColumn("bases", F.regexp_replace("seq", "[^ACGT]", "N"))
        rows = rows.withColumn("p", F.explode(F.sequence(F.col("lead"), last)))
        words = [F.substring(F.col("bases"), F.col("p") + 1, F.lit(k)) for k in sizes]
        rows = rows.withColumn("word", words[0] if len(words) == 1 else F.explode(F.array(*words))).drop("bases")
        rows = rows.withColumn("skip", F.greatest(F.col("p") - longest, F.lit(0)))
        rows = rows.withColumn("seq", F.substring(F.col("seq"), F.col("skip") + 1, F.col("p") - F.col("skip") + longest))
        rows = rows.withColumn("start", F.col("offset") - F.col("lead") + F.col("skip")).withColumn("p", F.col("p") - F.col("skip"))
    hits = rows.join(F.broadcast(seeds) if few else seeds.hint("merge"), "word").withColumn("first", F.col("p") - F.col("at"))
    hits = hits.where((F.col("first") >= 0) & (F.col("first") + F.col("n") <= F.length("seq")))
    hits = hits.withColumn("site", F.substring(F.col("seq"), F.col("first") + 1, F.col("n")))
    most = max(m for _, m, _ in counts)
    hits = hits.where(F.levenshtein("oseq", "site", most) >= 0)  # never more than the mismatches, and cheaper to bound
    hits = hits.withColumn("mismatches", hamming(F.col("oseq"), F.col("site")).cast("int")).where("mismatches <= m")
    size = F.floor(F.col("n") / (F.col("m") + 1)).cast("int")
    part = lambda c, i: F.substring(F.col(c), i * size + 1, size)
    whole = F.exists(F.sequence(F.lit(0), F.col("m")), lambda i: (part("oseq", i) == part("site", i)) & ~part("oseq", i).contains("N"))
    hits = hits.where(~F.col("oseq").contains("N") | whole)
    return hits.select("oligo", "strand", "name", "seq_id", (F.col("start") + F.col("first")).alias("pos"), "n", "mismatches").distinct()


def search_primers(primers: DataFrame, sequences: DataFrame, mismatch: float = 0.1, max_product: int = 5000) -> DataFrame:
    """Amplimers: one oligo of a pair forward and the other on the opposite strand downstream, at most ``max_product`` apart.

    Columns primer_name, target, target_fasta_id, length, fwd_oligo, fwd_start (from 1), rev_oligo, rev_end (from 1, inclusive).
    """
    arms = primers.select("name", F.explode(F.array(F.struct(F.lit("fwd").alias("arm"), F.col("forward_seq").alias("seq")), F.struct(F.lit("rev").alias("arm"), F.col("reverse_seq").alias("seq")))).alias("x"))
    oligos = arms.select(F.concat_ws("\t", "name", "x.arm").alias("oligo"), F.col("x.seq").alias("seq"))
    hits = search_oligos(oligos, sequences, mismatch).withColumn("primer_name", F.split("oligo", "\t")[0]).withColumn("arm", F.split("oligo", "\t")[1])
    left = hits.where("strand = '+'").select("primer_name", "seq_id", F.col("name").alias("target"), F.col("arm").alias("fwd_oligo"), (F.col("pos") + 1).alias("fwd_start"), F.col("n").alias("fwd_n"))
    right = hits.where("strand = '-'").select("primer_name", "seq_id", F.col("arm").alias("rev_oligo"), (F.col("pos") + F.col("n")).alias("rev_end"), F.col("n").alias("rev_n"))
    # Range join by bins as wide as the largest product: partners lie in the same bin or the next.
    left = left.withColumn("bin", F.explode(F.array(F.floor(F.col("fwd_start") / max_product), F.floor(F.col("fwd_start") / max_product) + 1)))
    right = right.withColumn("bin", F.floor(F.col("rev_end") / max_product))
    pairs = left.join(right, ["primer_name", "seq_id", "bin"]).withColumn("length", F.col("rev_end") - F.col("fwd_start") + 1)
    pairs = pairs.where((F.col("fwd_oligo") != F.col("rev_oligo")) & (F.col("length") >= F.col("fwd_n") + F.col("rev_n")) & (F.col("length") <= max_product))
    return pairs.select("primer_name", "target", F.col("seq_id").alias("target_fasta_id"), "length", "fwd_oligo", "fwd_start", "rev_oligo", "rev_end").distinct()


def offtarget_hits(queries: DataFrame, database: DataFrame, max_alignment: int = 15) -> DataFrame:
    """Names of ``queries`` (name, seq) that share an ungapped exact match longer than ``max_alignment`` with ``database`` (seq), on
    either strand. Mismatched extensions are not followed, so this is laxer than a local aligner."""
    k = max_alignment + 1
    known = database.select(F.upper("seq").alias("seq"))
    known = known.union(known.select(reverse_complement(F.col("seq")))).select(F.lit("").alias("name"), F.lit("").alias("seq_id"), "seq")
    known = windows(known, k).select("kmer").distinct()
    own = queries.select("name", F.lit("").alias("seq_id"), F.upper("seq").alias("seq"))
    return windows_among(own, k, known).select("name").distinct()


def screen_offtarget(primers: DataFrame, database: DataFrame, max_alignment: int = 15) -> DataFrame:
    """Primer pairs none of whose oligos hits the database."""
    oligos = primers.select("name", F.explode(F.array("forward_seq", "reverse_seq")).alias("seq"))
    return primers.join(offtarget_hits(oligos, database, max_alignment), "name", "left_anti")


def conserved_blocks(sequences: DataFrame, k: int = 20, max_gap: int = 30, min_length: int = 50, queries: DataFrame | None = None) -> DataFrame:
    """(query, subject, start, end, sstart, sim_errors): stretches that two genomes share on one diagonal.

    Anchors are k-mers that stand once in each genome, so a repeat costs no pairs. Anchors of one diagonal at most ``max_gap``
    apart make a block; bases of a block that no anchor covers count as ``sim_errors``. ``queries`` (name, seq_id, seq) are those of the genomes, with all their
    records, that are wanted as queries: then only their words are counted in the others, and no two other genomes are compared.
    """
    spelled = lambda rows: windows(rows.select("name", "seq_id", F.upper("seq").alias("seq")), k)
    w = spelled(sequences)
    if queries is not None:
        w = w.join(sized(spelled(queries).select("kmer").distinct()), "kmer", "left_semi")
    once = w.groupBy("name", "kmer").agg(F.count("*").alias("n"), F.min("pos").alias("pos")).where("n = 1").drop("n")
    if queries is not None:
        once = stored(once, "words")  # read on both sides of the join
    own = once if queries is None else once.join(sized(queries.select("name").distinct()), "name", "left_semi")
    a, b = own.select("kmer", F.col("name").alias("query"), F.col("pos").alias("qpos")), once.select("kmer", F.col("name").alias("subject"), F.col("pos").alias("spos"))
    anchors = a.join(b, "kmer").where("query <> subject").withColumn("diag", F.col("qpos") - F.col("spos"))
    order = Window.partitionBy("query", "subject", "diag").orderBy("qpos")
    before = F.lag("qpos").over(order) + k
    anchors = anchors.withColumn("gap", F.greatest(F.col("qpos") - before, F.lit(0))).withColumn("new", F.when(F.col("gap").isNull() | (F.col("gap") > max_gap), 1).otherwise(0))
    anchors = anchors.withColumn("block", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = anchors.groupBy("query", "subject", "diag", "block").agg(
        F.min("qpos").alias("start"), (F.max("qpos") + k).alias("end"), F.min("spos").alias("sstart"), F.sum(F.when(F.col("new") == 0, F.col("gap")).otherwise(0)).alias("sim_errors")
    )
    return out.where(F.col("end") - F.col("start") >= min_length).select("query", "subject", "start", "end", "sstart", "sim_errors")
