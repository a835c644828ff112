"""Attribute text of features, ids and comments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_value(attributes: Column, key: str) -> Column:
    """The first ``key=value`` anywhere in the text, unanchored; null without one."""
    return F.nullif(F.regexp_extract(attributes, f"{key}=([^;]+)", 1), F.lit(""))


def has_value(attributes: Column, key: str, value: str) -> Column:
    """1 where key has the value, else 0; null for a null text."""
    return F.when(attributes.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce((first_value(attributes, key) == value).cast("int"), F.lit(0)))


def piece(attributes: Column, key: str) -> Column:
    """The value of the one piece that begins with ``key=``; empty unless there is exactly one."""
    found = F.filter(F.split(attributes, ";"), lambda x: F.trim(x).startswith(f"{key}="))
    return F.when(F.size(found) == 1, F.substring_index(F.trim(F.get(found, 0)), "=", -1)).otherwise(F.lit(""))


def others(attributes: Column) -> Column:
    """The pieces besides ID and Parent."""
    return F.array_join(F.filter(F.split(attributes, ";"), lambda x: ~F.trim(x).startswith("ID=") & ~F.trim(x).startswith("Parent=") & (F.trim(x) != "")), ";")


def rebuilt(own: Column, parent: Column, rest: Column) -> Column:
    """``ID=..;Parent=..;rest`` without empty pieces."""
    full = lambda c, pre: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(pre), c))
    return F.concat_ws(";", full(own, "ID="), full(parent, "Parent="), full(rest, ""))


def leading_id(attributes: Column) -> Column:
    """The id by position: the first piece without its first three characters."""
    return F.substring(F.get(F.split(attributes, ";"), 0), 4, 2**31 - 1)


def padded(number: Column, width: int = 10) -> Column:
    """Zero-padded, never cut."""
    s = number.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def locus_id(chr_id: Column, strand: Column, start: Column, end: Column) -> Column:
    """Sequence and padded start, or end on the minus strand."""
    return F.concat_ws("_", chr_id, padded(F.when(strand == 1, start).otherwise(end)))


FAMILIES = {"other": "UC", "RLK": "LRR-RLK", "RLP": "LRR-RLP", "NLR": "NBS-LRR"}


def family_name(family: Column) -> Column:
    out = family
    for old, new in FAMILIES.items():
        out = F.when(family == old, F.lit(new)).otherwise(out)
    return out


def origin_of(comment: Column) -> Column:
    """The origin that a model's comment names."""
    return F.nullif(F.regexp_extract(comment, r"Origin:([^/;\s]+)", 1), F.lit(""))


def model_comment(origin: Column, method: Column, identity: Column, coverage: Column) -> Column:
    pct = lambda c: F.format_string("%.2f", c)
    return F.concat_ws(" / ", F.concat(F.lit("Origin:"), origin), F.concat(F.lit("pred:"), method), F.concat(F.lit("prot-%-ident:"), pct(identity)), F.concat(F.lit("prot-%-cov:"), pct(coverage)))


#: Colours of canonical models, others, and others that equal their template.
COLOURS = (3, 2, 10)


def colour(valid: Column, same_as_template: Column) -> Column:
    good, bad, equal = COLOURS
    return F.when(valid, F.lit(good)).when(same_as_template, F.lit(equal)).otherwise(F.lit(bad))
