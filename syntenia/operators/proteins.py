"""Similarity of proteins from pairwise alignments."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.functions.sequences import smoothed


def similarity(marks: DataFrame, keys: Sequence[str], column: str = "marks") -> DataFrame:
    """(weighted, identical, positive, homology) from residue marks 2, 1, 0.

    homology is the share of residues that stay non-zero once isolated ones are
    masked and gaps beside kept ones filled; weighted is positive times homology.
    """
    s = smoothed(F.col(column))
    n = F.size(column)
    count = lambda arr, test: F.size(F.filter(arr, test))
    rows = marks.select(*keys, count(F.col(column), lambda x: x == 2).alias("identical"), count(F.col(column), lambda x: x > 0).alias("positive"), F.when(n > 0, count(s, lambda x: x > 0) / n).otherwise(F.lit(0.0)).alias("homology"))
    return rows.withColumn("weighted", F.col("positive") * F.col("homology"))


def ranked_hits(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds 0-based ranks by query and by subject start."""
    rank = lambda c: F.row_number().over(Window.partitionBy(*keys).orderBy(c, "qstart", "sstart")) - 1
    return hits.withColumn("query_rank", rank("qstart")).withColumn("subject_rank", rank("sstart"))


def colinear_chain(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Greedy chain by bit score of hits that stay in one order on query and subject; sums of its metrics."""
    names = ["bitscore", "positive", "nident", "length"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        kept: list[tuple] = []
        total = dict.fromkeys(names, 0)
        for r in rows.sort_values(["bitscore", "qstart", "sstart"], ascending=[False, True, True]).itertuples():
            if all((r.qstart > k[1] and r.sstart > k[3]) or (r.qend < k[0] and r.send < k[2]) for k in kept):
                kept.append((r.qstart, r.qend, r.sstart, r.send))
                total = {n: total[n] + getattr(r, n) for n in names}
        return pd.DataFrame([{**{k: rows[k].iloc[0] for k in keys}, "n": len(kept), **total}])

    kinds = {f.name: f.dataType.simpleString() for f in hits.schema}
    fields = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return hits.groupBy(*keys).applyInPandas(run, f"{fields}, n long, bitscore double, positive long, nident long, length long")
