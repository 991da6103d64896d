"""Column functions over nucleotide strings; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements (fixed values).
IUPAC = "ACGTRYKMBVDHSWN"
COMPLEMENT = "TGCAYRMKVBHDSWN"
#: Ambiguity codes that the quality filter counts; N is not among them (fixed values).
AMBIGUOUS = "RYWSKMBDHV"


def clean(seq: Column) -> Column:
    """Upper case without gaps and padding."""
    return F.regexp_replace(F.upper(seq), "[-.]", "")


def to_dna(seq: Column) -> Column:
    return F.translate(F.upper(seq), "U", "T")


def only_acgt(seq: Column, keep_n: bool = False) -> Column:
    return F.regexp_replace(F.upper(seq), "[^ACGTN]" if keep_n else "[^ACGT]", "")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), IUPAC, COMPLEMENT))


def ambiguous_iupac(seq: Column) -> Column:
    """Ambiguity codes, N not counted."""
    return F.length(seq) - F.length(F.translate(F.upper(seq), AMBIGUOUS, ""))


def ambiguous_any(seq: Column) -> Column:
    """Everything but A, C, G and T."""
    return F.length(F.regexp_replace(F.upper(seq), "[ACGT]", ""))


def homopolymer(seq: Column) -> Column:
    """Longest run of one of A, C, G, T; 0 without any."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(F.upper(seq), F.lit("(A+|C+|G+|T+)"), F.lit(1)), F.length)), F.lit(0))


def longest_run(seq: Column) -> Column:
    """Longest run of any character."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(seq, F.lit(r"((.)\2*)"), F.lit(1)), F.length)), F.lit(0))


def passes_qc(seq: Column, *, max_ambigs: int = 0, max_poly: int = 8, min_length: int = 250, max_length: int = 600) -> Column:
    bare = clean(seq)
    runs = "|".join(f"{b}{{{max_poly + 1},}}" for b in "ACGT")
    return F.length(bare).between(min_length, max_length) & (ambiguous_iupac(bare) <= max_ambigs) & ~bare.rlike(runs)


def trim(seq: Column, start: int, end: int) -> Column:
    """Characters start to end, counted from 1, both included."""
    return F.substring(seq, start, end - start + 1)


def once(value: Column, f) -> Column:
    """f(value) with value worked out once, also where f puts it into a lambda."""
    return F.transform(F.array(value), f)[0]


def kmers(seq: Column, k: int, step: int = 1) -> Column:
    """All k-letter strings in order, none for short sequences; by blocks, as a place far into a text takes long to reach."""
    block = step * max(1, 512 // step)
    within = lambda p: F.transform(F.sequence(F.lit(1), F.least(F.lit(block), F.length(p) - k + 1), F.lit(step)), lambda i: F.substring(p, i, F.lit(k)))
    part = lambda s: F.transform(F.sequence(F.lit(0), F.floor((F.length(s) - k) / block).cast("int")), lambda j: once(F.substring(s, j * block + 1, F.lit(block + k - 1)), within))
    return once(seq, lambda s: F.when(F.length(s) >= k, F.flatten(part(s))).otherwise(F.array().cast("array<string>")))


def words(seq: Column, k: int = 8) -> Column:
    """Distinct k-letter strings of A, C, G, T only (U as T)."""
    return F.array_distinct(F.filter(kmers(to_dna(seq), k), lambda w: w.rlike("^[ACGT]+$")))


def kmers_without_n(seq: Column, k: int) -> Column:
    return F.filter(kmers(seq, k), lambda w: ~F.contains(w, F.lit("N")))


def minimizers(seq: Column, k: int = 8, m: int = 4) -> Column:
    """The alphabetically first m-letter string of every k-letter string."""
    return F.transform(kmers(seq, k), lambda w: F.array_min(F.transform(F.sequence(F.lit(1), F.lit(k - m + 1)), lambda i: F.substring(w, i, F.lit(m)))))


def encode(word: Column) -> Column:
    """Two bits a base as a long; null with other letters."""
    digits = F.translate(F.upper(word), "ACGT", "0123")
    return F.when(F.upper(word).rlike("^[ACGT]+$"), F.conv(digits, 4, 10).cast("long"))


def hamming(a: Column, b: Column) -> Column:
    """Differing places over the shorter length."""
    n = F.least(F.length(a), F.length(b))
    return F.when(n > 0, F.size(F.filter(F.sequence(F.lit(1), n), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))).otherwise(F.lit(0))


def normalize_id(seq_id: Column) -> Column:
    """Cut at the first dot, else before "_S00"."""
    return F.when(F.contains(seq_id, F.lit(".")), F.substring_index(seq_id, ".", 1)).otherwise(F.substring_index(seq_id, "_S00", 1))


def sample_name(name: Column) -> Column:
    return F.regexp_replace(name, r"_S\d+$", "")
