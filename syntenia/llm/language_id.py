"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text (a bounded sample) is built.
A text is parsed from left to right into the longest phrases that occur in a
language's sample; c phrases over m bytes against a sample of n bytes estimate the
cross-entropy c * log2(n) / m, and the language with the least wins.

The automata run over UTF-8 bytes of the lower-cased text, where every ASCII byte that
isn't a letter counts as a space; so the transition tables are dense whatever the script.
Texts are parsed whole, as pieces of ``PIECE`` bytes; all pieces of a batch
step through a table together, so the work is a few array operations for each
byte position of a piece, and one huge text is as cheap as many small ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from syntenia.llm import common

#: Bound of the fit: distinct texts for a language, characters of each, and bytes of all samples together.
FIT_TEXTS, FIT_CHARS, FIT_BYTES = 64, 1024, 1 << 18
#: Bytes of a piece of text, and of the texts that are parsed together.
PIECE, TOGETHER = 512, 4 << 20
UNKNOWN = "und"


def _folded() -> np.ndarray:
    """Class of each byte before compaction: ASCII other than lower-case letters is a space."""
    out = np.arange(256)
    out[:128][[not chr(i).islower() for i in range(128)]] = 32
    return out


FOLDED = _folded()


class Automaton:
    """A suffix automaton as a dense table: a row of transitions for each state.

    Row 0 has none, so a failed step and a phrase's end are the same state.
    """

    def __init__(self, sample: bytes):
        text = FOLDED[np.frombuffer(sample, np.uint8)]
        used = np.unique(text)
        self.width = len(used) + 1  # class 0: bytes that the sample lacks
        self.classes = np.zeros(256, np.int32)
        self.classes[used] = np.arange(1, len(used) + 1)
        self.classes = self.classes[FOLDED]
        nexts = _suffix_automaton(text.tolist())
        table = np.zeros((len(nexts) + 1, self.width), np.int32)
        rank = {b: i + 1 for i, b in enumerate(used.tolist())}
        for state, out in enumerate(nexts):
            for b, to in out.items():
                table[state + 1, rank[b]] = (to + 1) * self.width
        self.table, self.first = table.ravel(), table[1].copy() if len(nexts) else np.zeros(self.width, np.int32)
        self.bits = float(np.log2(max(2, len(sample))))

    def phrases(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of each piece data[start : start + length]; pieces are sorted from the longest down."""
        classes = self.classes[data]
        state, count = np.zeros(len(start), np.int32), np.zeros(len(start), np.int32)
        for j in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -j, "left"))  # pieces longer than j
            c = classes[start[:n] + j]
            to = self.table[state[:n] + c]
            ends = to == 0
            count[:n] += ends
            state[:n] = np.where(ends, self.first[c], to)
        return count


def _suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the suffix automaton, state 0 first (online construction with clones)."""
    nexts: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for b in text:
        new, p = len(nexts), last
        nexts.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        while p >= 0 and b not in nexts[p]:
            nexts[p][b] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][b]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(b) == q:
                    nexts[p][b] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return nexts


@lru_cache(maxsize=2)
def _automata(samples: tuple[bytes, ...]) -> list[Automaton]:
    """Built once in each worker process."""
    return [Automaton(s) for s in samples]


def parsed(samples: tuple[bytes, ...], data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cross-entropy (texts x languages) of the texts data[ends[i] : ends[i + 1]]; infinite for empty ones."""
    size = np.diff(ends)
    n = -(-size // PIECE)
    of = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    start = ends[:-1][of] + nth * PIECE
    length = np.minimum(PIECE, ends[1:][of] - start)
    order = np.argsort(-length, kind="stable")
    start, length, of = start[order], length[order], of[order]
    out = np.full((len(size), len(samples)), np.inf)
    some = size > 0
    for k, a in enumerate(_automata(samples)):
        c = np.bincount(of, a.phrases(data, start, length), len(size))
        out[some, k] = c[some] * a.bits / size[some]
    return out


def _batches(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes of a binary column and the ends of its values, some megabytes at a time; a value isn't cut."""
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + TOGETHER, "right")) - 1)
        yield data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 4 == 2


def samples_by_language(docs: DataFrame, texts: int = FIT_TEXTS, chars: int = FIT_CHARS, total: int = FIT_BYTES) -> dict[str, bytes]:
    """Labelled text of each language: of its ``texts`` first distinct texts by hash, ``chars`` characters of each.

    Held-out documents and those without a language or a letter aren't learned from. All samples
    together have at most about ``total`` bytes, whatever the number of languages.
    """
    low = F.lower(common.text_or_empty())
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & _has_letter(F.col("text")))
    known = known.select(F.col("lang").cast("string").alias("lang"), F.xxhash64(low).alias("h"), F.substring(low, 1, chars).alias("part"))
    first = known.select("lang", "h").distinct().withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= texts)
    chosen = F.broadcast(docs.sparkSession.createDataFrame([tuple(r) for r in first.select("lang", "h").collect()], "lang string, h long"))
    parts = known.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.min("part").alias("part")).orderBy("lang", "h").collect()
    out: dict[str, list[str]] = {}
    for r in parts:
        out.setdefault(r["lang"], []).append(r["part"])
    return {k: " ".join(v).encode()[: max(1024, total // len(out))] for k, v in out.items()}


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def languages(docs: DataFrame, fit: DataFrame | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits) of every whole text of ``docs``, learned from ``fit`` (``docs`` itself by default).

    bits is the least cross-entropy a byte; score is 1 - least / second least, 1 if only one language was
    learned. Equal entropies go to the smaller name. Null text, empty text and text without a letter give
    ``und``, score 0 and null bits; so does everything if nothing was learned. A null doc_id is not held out.
    Repeated rows give a row each; an empty table gives none. Other columns aren't read, so names
    can't clash. Texts of any length: a task holds one batch and its piece states.
    """
    learned = samples_by_language(docs if fit is None else fit)
    names = sorted(learned)
    samples = tuple(learned[x] for x in names)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred: list[str] = []
            score, bits = np.zeros(b.num_rows), np.full(b.num_rows, np.nan)
            at = 0
            for data, ends in _batches(b.column(2)):
                n = len(ends) - 1
                if not names:
                    pred += [UNKNOWN] * n
                    at += n
                    continue
                h = parsed(samples, data, ends)
                best = h.argmin(1)
                least = h[np.arange(n), best]
                ok = np.isfinite(least)
                second = np.partition(h, 1, axis=1)[:, 1] if len(names) > 1 else np.full(n, np.inf)
                score[at : at + n][ok] = np.clip(1 - least[ok] / second[ok], 0, 1)
                bits[at : at + n][ok] = least[ok]
                pred += [names[k] if good else UNKNOWN for k, good in zip(best, ok)]
                at += n
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score), pa.array(bits, mask=np.isnan(bits))], schema=schema)

    low = F.when(_has_letter(F.col("text")), F.lower(common.text_or_empty())).otherwise(F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), low.cast("binary").alias("bytes"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, bits double")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of ``documents``; edge cases as in ``languages``."""
    return languages(common.table(spark, sf_dir, "documents"))
