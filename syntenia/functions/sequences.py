"""Nucleotide and protein text."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC letters and their complements.
LETTERS, COMPLEMENTS = "ACGTRYKMBVDHacgtrykmbvdh", "TGCAYRMKVBHDtgcayrmkvbhd"
#: The standard genetic code, codons in the order T, C, A, G.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODE = dict(zip(("".join(c) for c in product("TCAG", repeat=3)), AMINO_ACIDS))
STOPS = ("TAA", "TAG", "TGA")
FRAME_MARK = "!!!"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, LETTERS, COMPLEMENTS))


def stranded(seq: Column, strand: Column) -> Column:
    return F.when(strand.cast("string").isin("-", "-1"), reverse_complement(seq)).otherwise(seq)


def letters(seq: Column, start: Column, size: Column) -> Column:
    """Letters of an ASCII sequence by place, without a walk from its start."""
    return F.substring(seq.cast("binary"), start.cast("int"), size.cast("int")).cast("string")


def piece(seq: Column, start: Column, end: Column) -> Column:
    """Closed 1-based stretch, clamped to the sequence."""
    first = F.greatest(start, F.lit(1))
    return letters(seq, first, F.greatest(F.lit(0), F.least(end, F.octet_length(seq)) - first + 1))


def codons(seq: Column) -> Column:
    """Whole codons; a rest of one or two letters is dropped."""
    return F.regexp_extract_all(seq, F.lit("(?s).{3}"), F.lit(0))


def _by_digits() -> Column:
    """Amino acids by the codon's letters as digits: T, C, A, G are 0 to 3, any other letter is 4."""
    digit = {c: i for i, c in enumerate("TCAG")}
    out = ["X"] * 445
    for codon, acid in CODE.items():
        out[int("".join(str(digit[c]) for c in codon))] = acid
    return F.array(*[F.lit(x) for x in out])


def translate(seq: Column) -> Column:
    """Protein of all codons, stops as ``*``, unknown codons as ``X``."""
    digits = F.translate(F.regexp_replace(F.upper(seq), "[^TCAG]", "4"), "TCAG", "0123")
    return F.array_join(F.transform(codons(digits), lambda c: F.get(_by_digits(), c.cast("int"))), "")


def translate_to_stop(seq: Column) -> Column:
    """Protein up to the first stop, and a closing ``*``."""
    return F.concat(F.substring_index(translate(seq), "*", 1), F.lit("*"))


def _at(seq: Column, position: Column, size: int) -> Column:
    """Letters from a 1-based position on; null outside the sequence."""
    inside = (position >= 1) & (position + (size - 1) <= F.octet_length(seq))
    return F.when(inside, F.upper(letters(seq, position, F.lit(size))))


def is_stop(seq: Column, position: Column, strand: Column) -> Column:
    """Plus: the codon that ends at the position; minus: the one that begins there, read in reverse."""
    plus, minus = _at(seq, position - 2, 3), reverse_complement(_at(seq, position, 3))
    return F.coalesce(F.when(strand == "-", minus).otherwise(plus).isin(*STOPS), F.lit(False))


def is_start(seq: Column, position: Column, strand: Column) -> Column:
    plus, minus = _at(seq, position, 3), _at(seq, position - 2, 3)
    return F.coalesce(F.when(strand == "-", minus == "CAT").otherwise(plus == "ATG"), F.lit(False))


def canonical_intron(seq: Column, before: Column, after: Column, strand: Column) -> Column:
    """Whether the intron between a CDS end and the next CDS start has canonical sites.

    Plus: GT or GC .. AG. Minus, in plus-strand letters: CT .. AC or GC.
    """
    left, right = _at(seq, before + 1, 2), _at(seq, after - 2, 2)
    plus = left.isin("GT", "GC") & (right == "AG")
    minus = (left == "CT") & right.isin("AC", "GC")
    return F.coalesce(F.when(strand == "-", minus).otherwise(plus), F.lit(False))


#: Shifts of an intron's two ends, in the order in which they are tried.
SPLICE_SHIFTS = ((-2, -2), (-2, 1), (-1, -1), (-1, 2), (1, 1), (1, -2), (2, 2), (2, -1))


def splice_shift(seq: Column, before: Column, after: Column, strand: Column) -> Column:
    """struct(left, right): the first shift that makes the intron canonical, else zeros."""
    pair = lambda a, b: F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"))
    tries = [F.when(canonical_intron(seq, before + a, after + b, strand), pair(a, b)) for a, b in SPLICE_SHIFTS]
    return F.when(canonical_intron(seq, before, after, strand), pair(0, 0)).otherwise(F.coalesce(*tries, pair(0, 0)))


def find_stop(seq: Column, position: Column, strand: Column, codons_: int = 20) -> Column:
    """The nearest in-frame stop within ``codons_`` codons downstream; null if none."""
    step = F.when(strand == "-", F.lit(-3)).otherwise(F.lit(3))
    at = F.transform(F.sequence(F.lit(1), F.lit(codons_)), lambda i: position + step * i)
    return F.get(F.filter(at, lambda p: is_stop(seq, p, strand)), 0)


def find_start(seq: Column, position: Column, strand: Column, codons_: int = 20) -> Column:
    """The nearest in-frame start upstream, unless a stop comes first; null if none."""
    step = F.when(strand == "-", F.lit(3)).otherwise(F.lit(-3))
    at = F.transform(F.sequence(F.lit(1), F.lit(codons_)), lambda i: position + step * i)
    edge = F.when(strand == "-", F.lit(-2)).otherwise(F.lit(2))
    hits = F.filter(at, lambda p: is_start(seq, p, strand) | is_stop(seq, p + edge, strand))
    first = F.get(hits, 0)
    return F.when(~is_stop(seq, first + edge, strand), first)


def no_start(codon: Column) -> Column:
    return F.coalesce(F.upper(codon) != "ATG", F.lit(True))


def no_stop(codon: Column) -> Column:
    return F.coalesce(~F.upper(codon).isin(*STOPS), F.lit(True))


def smoothed(values: Column, reach: int = 2, least: int = 5) -> Column:
    """Values whose window sum is below ``least`` become 0; then zeros beside a value become 3."""
    window = lambda v, i: F.slice(v, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1)
    once = F.transform(values, lambda x, i: F.when(F.aggregate(window(values, i), F.lit(0), lambda a, b: a + b) < least, F.lit(0)).otherwise(x))
    return F.element_at(F.transform(F.array(once), lambda v: F.transform(v, lambda x, i: F.when((x == 0) & (F.array_max(window(v, i)) > 0), F.lit(3)).otherwise(x))), 1)
