"""Token counts by overlap resynchronisation.

Ordinary texts are counted by the pieces between their spaces. A huge text is cut into chunks that
overlap; each chunk is encoded with offsets, and neighbouring encodings are
spliced at a boundary that both agree on and that is proven stable. If an
overlap holds no such boundary it is widened and the chunk encoded again.

A boundary is stable when the token before it ends at or before a white-space
character and the next token starts after it: the vocabularies served here
split at white space before any merge, their normalisers map each white-space
run to one space and compose no characters across it, and no special string
holds white space. In text without spaces, so is the end of a run of letters before
a digit or a mark, where the vocabulary's pre-tokenizer is seen to cut there: a run of
letters ends whatever stands around it, and normalisers compose no digit or mark with
a letter. Both encodings must give ``AGREE`` equal tokens (ids and absolute offsets)
on each side of the boundary, or reach an end of the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.llm import common

#: Characters of a chunk, of the first overlap, and tokens that must agree.
CHUNK, OVERLAP, AGREE = 1 << 16, 512, 4
#: Texts of a batch that go to the tokenizer at once.
BATCH = 64
LIMIT = 2048


class Spliced:
    """Counts the tokens of a text by encoding overlapping chunks."""

    def __init__(self, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer, self.chunk, self.overlap = tokenizer, chunk, overlap
        self.widened = 0
        self.letters_end = _cuts_letters(tokenizer)

    def _encode(self, text: str, lo: int, hi: int) -> list[tuple[int, int, int]]:
        e = self.tokenizer.encode(text[lo:hi], add_special_tokens=False)
        return [(i, a + lo, b + lo) for i, (a, b) in zip(e.ids, e.offsets)]

    def pieces(self, text: str) -> Iterator[list[int]]:
        """Token ids of the whole text, equal to one encoding of it, piece by piece."""
        n = len(text)
        hi = min(n, self.chunk)
        have = self._encode(text, 0, hi)
        while hi < n:
            overlap, cut = self.overlap, None
            while cut is None:
                lo = max(0, hi - overlap)
                end = min(n, lo + max(self.chunk, 2 * overlap))
                nxt = self._encode(text, lo, end)
                cut = self._stable(text, have, nxt, lo)
                if cut is None:
                    self.widened += 1
                    if have and lo <= have[0][1]:  # no boundary in all that isn't settled yet: encode that part as one
                        lo = have[0][1]
                        end = min(n, max(end, hi + self.chunk))
                        nxt, cut = self._encode(text, lo, end), (0, 0)
                    elif lo == 0:
                        cut = (0, 0)
                    overlap *= 2
            yield [t[0] for t in have[: cut[0]]]
            have, hi = nxt[cut[1] :], end
        yield [t[0] for t in have]

    def ids(self, text: str) -> list[int]:
        return [i for piece in self.pieces(text) for i in piece]

    def count(self, text: str) -> int:
        return sum(map(len, self.pieces(text)))

    def _ends(self, text: str, a: int) -> bool:
        """Whether tokens can't reach over position a whatever stands around it."""
        if text[a - 1].isspace():
            return True
        return self.letters_end and text[a - 1].isalpha() and unicodedata.category(text[a])[0] in "NPS"

    def _stable(self, text, left, right, lo) -> tuple[int, int] | None:
        """Positions in left and right of the middlemost proven boundary."""
        at = {a: j for j, (_, a, _) in reversed(list(enumerate(right)))}
        first = next((i for i in range(len(left) - 1, -1, -1) if left[i][1] < lo), -1) + 1
        found = []
        for i in range(first, len(left)):
            a = left[i][1]
            j = at.get(a)
            if j is None or a == 0 or not self._ends(text, a) or left[i - 1][2] > a:
                continue
            before, after = left[max(first, i - AGREE) : i], left[i : i + AGREE]
            if len(before) < AGREE or len(after) < AGREE or j < AGREE:
                continue
            if right[j - AGREE : j] == before and right[j : j + AGREE] == after:
                found.append((i, j))
        return found[len(found) // 2] if found else None


def _cuts_letters(tokenizer) -> bool:
    """Whether the pre-tokenizer ends runs of letters before digits and marks, and so starts anew there."""
    sample = "ab1cd.ef,g_h/i=日本2語。x<y'z"
    ends = {i for i in range(1, len(sample)) if sample[i - 1].isalpha() and not sample[i].isalpha()}
    if tokenizer.pre_tokenizer is None:
        return False
    return ends <= {a for _, (a, _) in tokenizer.pre_tokenizer.pre_tokenize_str(sample)}


class WordCounts(dict):
    """Tokens of the pieces between spaces and line feeds, kept for the pieces seen lately.

    Both characters are stable boundaries, so the pieces' counts add up to the
    text's. ``LIMIT`` bounds the memory, not the results: at half of it the pieces become
    the older half, of which those that are met again move on and the rest is dropped.
    """

    LIMIT, LONGEST = 1_000_000, 64

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.older: dict[str, int] = {}

    def of(self, texts: pa.Array) -> np.ndarray:
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        met = pieces.flatten().dictionary_encode()
        sizes = np.array(self.counts(met.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64)[met.indices.to_numpy()]
        upto, ends = np.concatenate(([0], np.cumsum(sizes))), np.cumsum(pc.list_value_length(pieces).to_numpy())
        return np.diff(upto[ends], prepend=0)

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each of the distinct ``pieces``; looks up these only, so a call costs the same however much is kept."""
        out = list(map(self.get, pieces))
        new = [w for w, n in zip(pieces, out) if n is None]
        got = {w: self.older[w] for w in new if w in self.older}
        rest = [w for w in new if w not in got]
        got.update(zip(rest, map(len, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))))
        out = [got[w] if n is None else n for w, n in zip(pieces, out)]
        self.update((w, n) for w, n in got.items() if len(w) <= self.LONGEST)
        if 2 * len(self) > self.LIMIT:
            self.older = dict(self)
            self.clear()
        return out


@lru_cache(maxsize=1)
def _counter(vocabulary: str) -> WordCounts:
    """One for each worker process: its tasks share what it has seen."""
    return WordCounts(load_tokenizer(vocabulary))


def count_tokens(words: WordCounts, spliced: Spliced, texts: pa.Array) -> np.ndarray:
    """Tokens of each text: ordinary ones by their pieces, huge ones spliced from chunks."""
    huge = pc.greater(pc.utf8_length(texts), spliced.chunk).to_numpy(zero_copy_only=False)
    out = np.zeros(len(texts), np.int64)
    out[~huge] = words.of(texts.filter(pa.array(~huge)))
    for i in np.flatnonzero(huge):
        out[i] = spliced.count(texts[int(i)].as_py())
    return out


def load_tokenizer(name: str):
    """The tokenizer of a public vocabulary file, without truncation or padding."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def token_counts(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    Null text counts as empty (0 bytes, 0 tokens). Repeated rows and ids give a
    row each; an empty table gives no rows; other columns of ``docs`` are not
    read, so names cannot clash. Texts of any length: the memory of a task is a
    batch of texts and a chunk's encoding; a text that has no stable boundary at all
    (one run of letters) is encoded in ever larger parts.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _counter(vocabulary)
        spliced = Spliced(words.tokenizer, chunk, overlap)
        for b in batches:
            counts = [pa.array(count_tokens(words, spliced, b.column(1).slice(k, BATCH))) for k in range(0, b.num_rows, BATCH)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.concat_arrays([pa.array([], pa.int64()), *counts]), b.column(2)], ["doc_id", "n_tokens", "n_bytes"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    got = src.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, "doc_id long, n_tokens long, n_bytes long")
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each text of ``documents``; edge cases as in ``token_counts``."""
    return token_counts(common.table(spark, sf_dir, "documents"))
