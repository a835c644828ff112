"""Output of external aligners as tables. The aligners themselves are not part of the engine."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CDS = "target string, method string, gene string, start long, end long"


def similarity_rows(rows: DataFrame) -> DataFrame:
    """CDS rows from ``similarity`` features: each ``Align a b n`` piece covers b .. b + n - 1."""
    hits = rows.where((F.col("type") == "similarity") & (F.col("strand") == "+"))
    pieces = F.filter(F.transform(F.split("attributes", r"\s*;\s*"), lambda x: F.split(F.trim(x), r"\s+")), lambda p: F.get(p, 0) == "Align")
    each = hits.withColumn("__p", F.explode(pieces))
    start = F.get("__p", 1).cast("long")
    return each.withColumn("type", F.lit("CDS")).withColumn("start", start).withColumn("end", start + F.get("__p", 3).cast("long") - 1).drop("__p")


def renamed_rows(rows: DataFrame, kind: str) -> DataFrame:
    """Plus-strand rows of a kind (``exon`` or ``cds``) as CDS rows."""
    return rows.where((F.col("type") == kind) & (F.col("strand") == "+")).withColumn("type", F.lit("CDS"))


def _report(lines: list[str]) -> Iterator[tuple]:
    """Residue classes of the first alignment in a pairwise text report: 2 identical, 1 similar, 0 other."""
    length, marks, query, pad = 0, [], "", 0
    for line in lines:
        if line.startswith("Length=") and not length:
            length = int(line[7:])
        elif line.startswith("Query ") and len(line.split()) >= 4:
            _, first, query, _ = line.split()[:4]
            pad = line.index(query, len("Query "))
            if not marks:
                marks = [0] * (int(first) - 1)
        elif query and line.startswith(" ") and not line.startswith("Sbjct"):
            middle = line[pad : pad + len(query)].ljust(len(query))
            marks += [2 if m.isalpha() else 1 if m == "+" else 0 for q, m in zip(query, middle) if q != "-"]
            query = ""
        elif line.startswith(" Score") and marks:
            break
    yield length, marks + [0] * max(0, length - len(marks))


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, marks) of each pairwise report file."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, *r) for p, t in zip(b["path"], b["text"]) for r in _report(t.splitlines())]
            yield pd.DataFrame(rows, columns=["path", "length", "marks"])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return files.mapInPandas(run, "path string, length long, marks array<int>")


def hooked(pairs: DataFrame, aligner: Callable[[pd.DataFrame], pd.DataFrame], fields: str) -> DataFrame:
    """Runs an external aligner on batches of pairs; it gets and returns pandas frames."""
    return pairs.mapInPandas(lambda batches: map(aligner, batches), fields)


def tolerant(rows: DataFrame, message: str, known: Iterable[str], ignore_others: bool = False) -> DataFrame:
    """Rows without an error or with a known one; another error fails the job unless ignored."""
    m = F.coalesce(F.col(message), F.lit(""))
    fine = (m == "") | F.exists(F.array(*[F.lit(k) for k in known]), lambda k: F.contains(m, k))
    bad = F.lit(ignore_others) if ignore_others else F.raise_error(F.concat(F.lit("aligner: "), m)).cast("boolean")
    return rows.where(F.when(fine, F.lit(True)).otherwise(bad)).where(m == "")
