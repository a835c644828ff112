"""Moving positions between a genome, targets cut out of it, and proteins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def target_chromosome(target: Column) -> Column:
    """The target's id without its last part."""
    return F.regexp_extract(target, "^(.*)_[^_]+$", 1)


def target_position(target: Column) -> Column:
    return F.regexp_extract(target, "_([0-9]+)$", 1).cast("long")


def to_target(position: Column, origin: Column, strand: Column) -> Column:
    """Genome to target: x - t + 1, on the minus strand t - x + 1."""
    return F.when(strand == "-", origin - position + 1).otherwise(position - origin + 1)


def to_genome(position: Column, origin: Column, strand: Column) -> Column:
    """Target to genome; the inverse of ``to_target``."""
    return F.when(strand == "-", origin - position + 1).otherwise(position + origin - 1)


def lifted(start: Column, end: Column, origin: Column, strand: Column, back: bool = False) -> Column:
    """struct(start, end) of a lifted interval; the ends swap on the minus strand."""
    move = to_genome if back else to_target
    a, b = move(start, origin, strand), move(end, origin, strand)
    return F.struct(F.least(a, b).alias("start"), F.greatest(a, b).alias("end"))


def genomic_position(cds: Column, protein_position: Column, strand: Column) -> Column:
    """Walk 3 * p nucleotides along CDS intervals in strand order; null beyond their end.

    ``cds`` is sorted by start; on the minus strand the walk begins at its end.
    """
    want = protein_position * 3
    order = F.when(strand == -1, F.reverse(cds)).otherwise(cds)
    zero = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))

    def step(acc: Column, x: Column) -> Column:
        size = x["end"] - x["start"] + 1
        inside = acc["at"].isNull() & (acc["seen"] <= want) & (want <= acc["seen"] + size)
        at = F.when(strand == -1, x["end"] - (want - acc["seen"])).otherwise(x["start"] + (want - acc["seen"]))
        return F.struct((acc["seen"] + size).alias("seen"), F.when(inside, at).otherwise(acc["at"]).cast("long").alias("at"))

    return F.aggregate(order, zero, step, lambda acc: acc["at"])
