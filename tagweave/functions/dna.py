"""Column expressions over DNA strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC nucleotide codes.
IUPAC = {
    "A": "A",
    "C": "C",
    "G": "G",
    "T": "T",
    "R": "AG",
    "Y": "CT",
    "M": "AC",
    "K": "GT",
    "S": "CG",
    "W": "AT",
    "H": "ACT",
    "B": "CGT",
    "V": "ACG",
    "D": "AGT",
    "N": "ACGT",
}

# Fixed value: base order in which generated barcodes count upwards.
GENERATOR_BASES = "ATCG"


def is_dna(column: Column) -> Column:
    """Only A, C, G and T."""
    return column.rlike("^[ACGT]*$")


def template_regex(template: str) -> str:
    """Anchored regular expression of an IUPAC template."""
    return "^" + "".join(f"[{IUPAC[code]}]" for code in template) + "$"


def matches_template(column: Column, template: str) -> Column:
    """Same length as the template and every base within its class."""
    return column.rlike(template_regex(template))


def reverse_complement(column: Column) -> Column:
    """Reversed, bases complemented; anything but ACGT is kept."""
    return F.reverse(F.translate(column, "ACGT", "TGCA"))


def base4(number: Column, length: int, bases: str = "ACGT") -> Column:
    """The last ``length`` base-4 digits of a number, written with four bases."""
    digits = F.concat(F.lit("0" * length), F.conv(number.cast("string"), 10, 4))
    return F.translate(F.right(digits, F.lit(length)), "0123", bases)


def generated_barcode(rank: Column, length: int = 16) -> Column:
    """Barcode of the rank-th distinct index (from 1); the all-A word is never used."""
    return base4(rank, length, GENERATOR_BASES)


def masks(column: Column) -> Column:
    """Array of (pos, mask, base): the string with one position hidden, for every position.

    Two strings are at Hamming distance 1 iff they share exactly one mask and differ in its base.
    """
    positions = F.sequence(F.lit(1), F.length(column))

    def hide(i: Column) -> Column:
        return F.struct(
            i.alias("pos"),
            F.concat(F.substring(column, F.lit(1), i - 1), F.lit("."), F.substring(column, i + 1, F.length(column))).alias("mask"),
            F.substring(column, i, F.lit(1)).alias("base"),
        )

    return F.when(F.length(column) > 0, F.transform(positions, hide))
