"""Sequence functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BASES, _AMINO = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def codon_table() -> dict[str, str]:
    """The standard genetic code, codons in TCAG order."""
    codons = [a + b + c for a in _BASES for b in _BASES for c in _BASES]
    return dict(zip(codons, _AMINO, strict=True)) | {"---": "-"}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTNacgtn-", "TGCANtgcan-"))


def chunks(seq: Column, n: int) -> Column:
    """Substrings of n letters; the last may be shorter; none for an empty string or null. Linear in the length."""
    return F.coalesce(F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{n}}}"), F.lit(0)), F.array().cast("array<string>"))


def translate(seq: Column) -> Column:
    """Protein of a coding sequence; unknown or partial codons are X."""
    table = F.create_map(*[F.lit(x) for pair in codon_table().items() for x in pair])
    return F.array_join(F.transform(chunks(F.upper(seq), 3), lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X"))), "")


def has_assembly_gap(seq: Column, n: int = 10) -> Column:
    return F.contains(F.upper(seq), F.repeat(F.lit("N"), n))


def matches(a: Column, b: Column) -> Column:
    """Positions at which two aligned strings agree, over the shorter length; linear in it."""
    letters = lambda s: F.filter(F.split(s, ""), lambda x: x != "")
    return F.size(F.filter(F.zip_with(letters(a), letters(b), lambda x, y: x == y), lambda same: same))


def longest_run(states: Column, stop: str = "L") -> Column:
    """Longest stretch of a codon-status string without ``stop``."""
    return F.array_max(F.transform(F.split(states, stop, -1), lambda s: F.length(s)))


def frame_balance(lengths: Column) -> Column:
    """Sum of indel lengths modulo 3, never negative."""
    return F.pmod(F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(3))


STOPS = ("TAA", "TAG", "TGA")


def mask_codon(codon: Column) -> Column:
    """XXX for a stop codon or one with a gap or a broken length; a wholly missing codon stays ``---``."""
    broken = codon.isin(*STOPS) | F.contains(codon, F.lit("-")) | (F.length(codon) % 3 != 0)
    return F.when(codon == "---", codon).when(broken, F.lit("XXX")).otherwise(codon)


def until_stop(seq: Column) -> Column:
    """Upper-case sequence up to and with the first stop codon, in any frame; empty if there is none."""
    return F.regexp_extract(F.upper(seq), f"(?s)^.*?(?:{'|'.join(STOPS)})", 0)


def coding_only(seq: Column) -> Column:
    """The upper-case letters alone, without gaps and introns."""
    return F.regexp_replace(seq, "[^A-Z]", "")


def is_complete_codon(codon: Column) -> Column:
    """Three letters, whatever else stands between them, or a wholly missing codon."""
    return (F.length(F.regexp_replace(codon, "[^A-Za-z]", "")) == 3) | (codon == "---")


def is_frameshift_codon(codon: Column) -> Column:
    """A number of gaps that three does not divide."""
    return F.length(F.regexp_replace(codon, "[^-]", "")) % 3 != 0
