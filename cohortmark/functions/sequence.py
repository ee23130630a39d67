"""Column expressions over nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the spacer between stitched records.
SPACER = "NNNNNCATCCATTCATTAATTAATTAATGAATGAATGNNNNN"
#: Fixed value: upper-case ambiguity codes other than N.
AMBIGUOUS = "[BDHKMRSVWY]"
#: IUPAC codes and their complements.
IUPAC, COMPLEMENT = "ACGTUMRWSYKVHDBN", "TGCAAKYWSRMBDHVN"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC + IUPAC.lower(), COMPLEMENT + COMPLEMENT.lower()))


def is_ambiguous(seq: Column) -> Column:
    """Upper-case codes only, as lower case may mean soft masking."""
    return seq.rlike(AMBIGUOUS)


def without_ambiguities(seq: Column) -> Column:
    return F.regexp_replace(seq, AMBIGUOUS, "N")


def bases(seq: Column, letters: str) -> Column:
    """How many characters of ``seq`` are in ``letters`` (upper case given, both cases counted)."""
    up = F.upper(seq)
    return F.length(up) - F.length(F.translate(up, letters, ""))


def gc_percent(seq: Column) -> Column:
    return F.when(F.length(seq) > 0, 100.0 * bases(seq, "GC") / F.length(seq)).otherwise(F.lit(0.0))


def melting_temp(seq: Column) -> Column:
    """Wallace's rule below 14 bases, the length-corrected GC rule from there on."""
    gc, n = bases(seq, "GC"), F.length(seq)
    at = bases(seq, "AT")
    return F.when(n < 14, 2.0 * at + 4.0 * gc).otherwise(64.9 + 41.0 * (gc - 16.4) / n)


#: Unified nearest-neighbour enthalpies (kcal/mol) and entropies (cal/mol/K) of dinucleotides read 5' to 3'; a pair of neighbours on the other strand
#: has the same. Then those of a terminal G or C, of a terminal A or T, and the entropy of symmetry.
STACKS = {
    "AA": (-7.9, -22.2), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3), "CA": (-8.5, -22.7), "GT": (-8.4, -22.4),
    "CT": (-7.8, -21.0), "GA": (-8.2, -22.2), "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9),
}
TERMINAL_GC, TERMINAL_AT, SYMMETRY = (0.1, -2.8), (2.3, 4.1), -1.4
#: Fixed value: the gas constant in cal/mol/K.
GAS = 1.987


def stacking(seq: Column, which: int) -> Column:
    """Sum over neighbours and ends of the enthalpy (0) or the entropy (1) of an upper-case duplex of A, C, G and T; null for other codes."""
    other = str.maketrans("ACGT", "TGCA")
    both = STACKS | {k[::-1].translate(other): v for k, v in STACKS.items()}
    value = F.create_map(*[F.lit(x) for k, v in sorted(both.items()) for x in (k, v[which])])
    pairs = F.transform(F.sequence(F.lit(1), F.length(seq) - 1), lambda i: F.try_element_at(value, F.substring(seq, i, F.lit(2))))
    end = lambda at: F.when(F.substring(seq, at, 1).isin("G", "C"), TERMINAL_GC[which]).otherwise(TERMINAL_AT[which])
    total = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) + end(1) + end(-1)
    return F.when((F.length(seq) > 1) & seq.rlike("^[ACGT]+$"), total)


def nearest_neighbour_temp(seq: Column, salt: float = 0.05, strands: float = 5e-8) -> Column:
    """Melting temperature by stacking of neighbours, with monovalent ``salt`` and a total concentration of ``strands`` in mol/l. Null for other codes than A, C, G and T."""
    own = seq == reverse_complement(seq)
    entropy = stacking(seq, 1) + F.when(own, SYMMETRY).otherwise(0.0) + 0.368 * (F.length(seq) - 1) * F.log(F.lit(salt))
    return 1000.0 * stacking(seq, 0) / (entropy + GAS * F.log(F.when(own, strands).otherwise(strands / 4))) - 273.15


def has_run(seq: Column, longest: int) -> Column:
    """True if some base stands more than ``longest`` times in a row."""
    return F.upper(seq).rlike("|".join(f"{b}{{{longest + 1}}}" for b in "ACGT"))


def kmers(seq: Column, k: int) -> Column:
    """Array of (pos, kmer), positions from 0; empty for shorter sequences."""
    n = F.length(seq) - k
    at = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda p: F.struct(p.alias("pos"), F.substring(seq, p + 1, F.lit(k)).alias("kmer")))


def matches(a: Column, b: Column, gap_matches: bool = True) -> Column:
    """Columns at which two aligned rows hold the same character."""
    hit = lambda x, y: F.when((x == y) & (F.lit(gap_matches) | (x != "-")), 1).otherwise(0)
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), hit), F.lit(0), lambda s, v: s + v)


def identity_distance(a: Column, b: Column, gap_matches: bool = True) -> Column:
    """1 - matches / length of two aligned rows; unequal lengths raise."""
    same = F.length(a) == F.length(b)
    return F.when(same, 1.0 - matches(a, b, gap_matches) / F.length(a)).otherwise(F.raise_error(F.lit("aligned rows differ in length")).cast("double"))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance as a part of the longer length: for rows that are not aligned."""
    return F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def hamming(a: Column, b: Column) -> Column:
    return F.length(a) - matches(a, b)


def filestem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
