"""Allele expressions, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_allele(allele: Column) -> Column:
    """Upper case without blanks; null where it isn't made of A, C, G and T."""
    text = F.upper(F.trim(allele))
    return F.when(text.rlike("^[ACGT]+$"), text)


def complement(allele: Column) -> Column:
    """The base-wise complement; other letters stay."""
    return F.translate(allele, "ACGT", "TGCA")


def is_palindromic(a1: Column, a2: Column) -> Column:
    """A/T or C/G pairs, whose strand the letters don't tell."""
    return F.concat(a1, a2).isin("AT", "TA", "CG", "GC")


def orientation(a1: Column, a2: Column, effect: Column, other: Column) -> Column:
    """How (a1, a2) lies to (effect, other): direct, flipped, complement, complement_flipped, or null.

    The plain letters are tried before the complements.
    """
    c1, c2 = complement(a1), complement(a2)
    return (
        F.when((a1 == effect) & (a2 == other), "direct").when((a1 == other) & (a2 == effect), "flipped")
        .when((c1 == effect) & (c2 == other), "complement").when((c1 == other) & (c2 == effect), "complement_flipped")
    )


def minor_frequency(frequency: Column) -> Column:
    """The frequency folded to at most 0.5; null outside (0, 1)."""
    return F.when((frequency > 0) & (frequency < 1), F.least(frequency, 1 - frequency))
