"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words, over all documents.
2. A randomised SVD of the TF-IDF passages of all documents, distributed: each task
   multiplies its passages with a random matrix and back (Y = A'(A W)); the sums give
   the leading eigenvectors of A'A, the latent space, by the Nystrom form
   Y (W'Y)^-1 Y', so the texts are read once for it. Every passage is indexed.
3. Cosine search: every document is swept by overlapping passages on several
   scales; each benchmark item is compared with the passages of its scale.
   An item of fewer than ``SHORT`` words is a small part of any passage, so the
   cosine alone may miss it: its rarest words, so many that ``MEET`` of them stand
   together in every leak, are looked up in all texts as well, and each such place is
   a candidate.
4. Candidates are verified on words: the longest common subsequence of the item
   and the passage's surroundings, and whether the item's answer (its last
   sentence, or last third) stands there literally. A document leaks an item if
   the subsequence holds ``SURE`` of the item's words, or ``LIKELY`` of them with
   the answer.

All that is gathered is of fixed size: frequencies and basis have ``DIM`` rows
whatever the corpus, and so many tasks at most send them as ``fit_tasks`` says; the
benchmark is taken in blocks of about ``ITEMS``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.llm import common
from syntenia.llm.shingles import parts_of, word_hashes

DIM, RANK, EXTRA = 1 << 15, 64, 16
FIT_TASKS = 16
ITEMS = 4096
STEP = 8  # words of a block; passages are whole blocks
SCALES = (16, 32, 64, 128)
COSINE, SURE, LIKELY = 0.4, 0.8, 0.6
SHORT, MEET = 16, 3
PIECE, LAP = 200_000, 2048  # words of a very long text that are taken at once, and by how many more than the longest item's they overlap
SEED = 5

#: Words are runs of ASCII letters and digits and of anything beyond ASCII.
NOT_WORD = np.array([not (0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80) for i in range(256)])


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode()


def words_of(text: str | None) -> np.ndarray:
    """Hashes of a text's words, in order."""
    return np.concatenate([word_hashes(part, NOT_WORD)[0] for _, _, part in parts_of([text], lowered)])


def features(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(24)).astype(np.int64) & (DIM - 1)


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, all positions of ``a`` at a time."""
    at: dict[int, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def answer_of(text: str) -> list[int]:
    """The words of the last sentence of several, else the last third (three words at least)."""
    sentences = [w for w in map(words_of, re.split(r"[.!?]\s+", text)) if len(w)]
    words = words_of(text)
    return (sentences[-1] if len(sentences) > 1 and len(sentences[-1]) >= 3 else words[-max(3, len(words) // 3) :]).tolist()


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(ids, word hashes of all, words of each) for runs of texts."""
    for k in range(0, batch.num_rows, 256):
        ids = batch.column(0).slice(k, 256).to_pylist()
        for first, end, part in parts_of(batch.column(1).slice(k, 256).to_pylist(), lowered):
            yield ids[first:end], *word_hashes(part, NOT_WORD)


BLOCKS = 64


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each feature, and documents in all."""
    size = DIM // BLOCKS

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIM, np.int64), 0
        for b in batches:
            for ids, h, counts in _parts(b):
                text = np.repeat(np.arange(len(counts)), counts)
                pairs = np.sort(text * DIM + features(h))
                df += np.bincount(pairs[np.r_[True, pairs[1:] != pairs[:-1]]] % DIM, minlength=DIM) if len(h) else 0
                n += len(ids)
        if n:
            parts = [df[k * size : (k + 1) * size].tobytes() for k in range(BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary()), pa.array([n] * BLOCKS, pa.int64())], ["block", "counts", "n"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        n: dict[int, int] = {}
        for b in batches:
            for k, c, m in zip(*(b.column(i).to_pylist() for i in range(3))):
                sums[k] = sums.get(k, 0) + np.frombuffer(c, np.int64)
                n[k] = n.get(k, 0) + m
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary()), pa.array([n[k] for k in sums], pa.int64())], ["block", "counts", "n"])

    schema = "block int, counts binary, n long"
    rows = docs.select("doc_id", "text").mapInArrow(count, schema).repartition(BLOCKS, "block").mapInArrow(add, schema).collect()  # BLOCKS rows
    df = np.zeros(DIM, np.int64)
    for r in rows:
        df[r["block"] * size : (r["block"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    return df, rows[0]["n"] if rows else 0


PASSAGE = 64
#: Passages that are multiplied at once.
HELD = 8192
#: The weight of a word that stands so often in a passage.
TF = np.r_[0, 1 + np.log(np.arange(1, PASSAGE + 1))]


def _laid_out(f: np.ndarray, sizes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Features of texts with room for so many each; DIM where there are none."""
    out = np.full(room.sum(), DIM, np.int32)
    out[np.arange(len(f)) + np.repeat(np.cumsum(room) - room - (np.cumsum(sizes) - sizes), sizes)] = f
    return out


def _weights(f: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """For each place of some passages its word's share of the unit TF-IDF passage."""
    cell = np.arange(f.size)
    line = np.sort(((cell // PASSAGE) * (DIM + 1) + f.ravel()) * PASSAGE + cell % PASSAGE)
    key = line // PASSAGE
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    n = np.diff(np.r_[starts, len(key)])
    tf = np.empty(f.size, np.int64)
    tf[key // (DIM + 1) * PASSAGE + line % PASSAGE] = np.repeat(n, n)
    tf = tf.reshape(f.shape)
    whole = TF[tf] * np.append(idf, 0)[f]
    norm = np.sqrt((whole * whole / tf).sum(1))
    return (whole / tf / np.maximum(norm, 1e-12)[:, None]).astype(np.float32)


def _back(f: np.ndarray, v: np.ndarray, y: np.ndarray, out: np.ndarray, lane: int = 8) -> None:
    """Adds A'y to ``out``: the places of each feature lie in lanes, whose sums are then added up."""
    cell = np.flatnonzero(f.ravel() < DIM)
    line = np.sort(f.ravel()[cell].astype(np.int64) * f.size + cell)
    col, cell = line // f.size, line % f.size
    starts = np.flatnonzero(np.r_[True, col[1:] != col[:-1]])
    n = np.diff(np.r_[starts, len(col)])
    lanes = -(-n // lane)
    first = np.cumsum(lanes) - lanes
    to = np.arange(len(col)) + np.repeat(first * lane - starts, n)
    row, val = np.zeros(lanes.sum() * lane, np.int32), np.zeros(lanes.sum() * lane, np.float32)
    row[to], val[to] = cell // PASSAGE, v.ravel()[cell]
    row, val = row.reshape(-1, lane), val.reshape(-1, 1, lane)
    sums = np.concatenate([np.matmul(val[k : k + 512], y.take(row[k : k + 512], axis=0))[:, 0] for k in range(0, len(row), 512)])
    out[col[starts]] += np.add.reduceat(sums, first)


def fit_tasks(spark: SparkSession) -> int:
    """So many tasks fit the basis at most, as each sends a matrix."""
    return max(FIT_TASKS, 2 * spark.sparkContext.defaultParallelism)


def latent_space(docs: DataFrame, idf: np.ndarray) -> np.ndarray:
    """DIM x RANK basis of the TF-IDF space of all passages of ``docs``, from a distributed randomised SVD."""
    wide, size = RANK + EXTRA, DIM // BLOCKS
    start = np.random.default_rng(SEED).standard_normal((DIM, wide)).astype(np.float32)

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((DIM, wide))
        wanted = np.vstack([start, np.zeros((1, wide), np.float32)])
        held, some = [], False

        def add(f: np.ndarray) -> None:
            v = _weights(f, idf)
            y = np.concatenate([np.matmul(v[k : k + PASSAGE, None], wanted.take(f[k : k + PASSAGE], axis=0))[:, 0] for k in range(0, len(f), PASSAGE)])
            _back(f, v, y, out)

        for b in batches:
            for _, h, counts in _parts(b):
                if len(h):
                    held.append(_laid_out(features(h), counts, -(-counts // PASSAGE) * PASSAGE).reshape(-1, PASSAGE))
                    some = True
                while sum(map(len, held)) > HELD:
                    f = np.concatenate(held)
                    add(f[:HELD])
                    held = [f[HELD:]]
        if some:
            if sum(map(len, held)):
                add(np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([out[k * size : (k + 1) * size].astype(np.float32).tobytes() for k in range(BLOCKS)], pa.binary())], ["block", "part"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(c, np.float32).astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.astype(np.float32).tobytes() for s in sums.values()], pa.binary())], ["block", "part"])

    schema = "block int, part binary"
    y = np.zeros((DIM, wide))
    for r in docs.select("doc_id", "text").coalesce(fit_tasks(docs.sparkSession)).mapInArrow(back, schema).repartition(BLOCKS, "block").mapInArrow(add, schema).collect():  # DIM x wide numbers
        y[r["block"] * size : (r["block"] + 1) * size] = np.frombuffer(r["part"], np.float32).reshape(size, wide)
    # W'Y is singular where the passages span fewer directions; these stay out
    value, vector = np.linalg.eigh((start.T @ y + y.T @ start) / 2)
    y = y @ (vector * np.where(value > 1e-7 * max(value[-1], 1e-30), 1 / np.sqrt(np.maximum(value, 1e-30)), 0.0))
    value, vector = np.linalg.eigh(y.T @ y)
    top = np.argsort(value)[::-1][:RANK]
    left, value = y @ (vector[:, top] / np.sqrt(np.maximum(value[top], 1e-30))), value[top]
    # whitened, so that no leading direction drowns the others; directions that hold nothing stay out
    scale = np.where(value > 1e-4 * max(value[0], 1e-12), 1 / np.sqrt(np.maximum(value, 1e-12)), 0.0)
    return (left * scale).astype(np.float32)


class Item:
    """What verification needs of a benchmark item."""

    def __init__(self, item_id: int, text: str):
        self.id, words = item_id, words_of(text)
        self.words, self.answer = words.tolist(), answer_of(text)
        self.known, self.counts = np.unique(words, return_counts=True)
        self.features = features(self.known)
        self.apart = len(np.unique(self.features)) == len(self.known)

    def rarest(self, idf: np.ndarray) -> tuple[np.ndarray, int]:
        """The words that fewest documents hold, and how many of them every leak has at least."""
        words = np.array(self.words, np.uint64)
        least = int(np.ceil(LIKELY * len(words) - 1e-9))  # words that a leak has in common
        meet = min(MEET, least)
        return np.unique(words[np.argsort(-idf[features(words)], kind="stable")[: len(words) - least + meet]]), meet


class Benchmark:
    """A block of items, with their latent vectors by scale."""

    def __init__(self, items: list[tuple[int, str]], basis: np.ndarray, idf: np.ndarray):
        self.items = [x for x in (Item(*i) for i in items) if x.words]
        # an item's surroundings are twice its words, so a piece's overlap holds them whole
        self.lap = LAP + 2 * max((len(x.words) for x in self.items), default=0)
        vectors: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, item in enumerate(self.items):
            words = np.array(item.words, np.uint64)
            for k in range(0, len(words), SCALES[-1]):
                part = words[k : k + SCALES[-1]]
                scale = next(s for s in SCALES if s >= len(part))
                vectors.setdefault(scale, []).append((i, basis[features(part)].sum(0)))
        self.scales = {s: (np.array([i for i, _ in v]), _unit(np.array([x for _, x in v], np.float32))) for s, v in vectors.items()}
        rarest = {i: x.rarest(idf) for i, x in enumerate(self.items) if len(x.words) < SHORT}
        owners = sorted((w, i) for i, (words, _) in rarest.items() for w in words.tolist())
        self.rare, self.first = np.unique(np.array([w for w, _ in owners], np.uint64), return_index=True)
        self.first, self.owner = np.r_[self.first, len(owners)], np.array([i for _, i in owners], np.int64)
        self.meet, self.reach = (np.array([f(i) for i in range(len(self.items))], np.int64) for f in (lambda i: rarest[i][1] if i in rarest else 0, self.reach_of))
        self.marked = np.zeros(1 << 16, bool)
        self.marked[self.rare & np.uint64(0xFFFF)] = True

    def reach_of(self, i: int) -> int:
        """How far on either side of a rarest word a short item's other words are looked for."""
        n = len(self.items[i].words)
        return n + n // 2

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) wherever a short item's rarest words stand together, sorted by item and position."""
        at = np.flatnonzero(self.marked[h & np.uint64(0xFFFF)])
        k = np.minimum(np.searchsorted(self.rare, h[at]), max(0, len(self.rare) - 1))
        hit = self.rare[k] == h[at] if len(self.rare) else np.zeros(0, bool)
        at, k = at[hit], k[hit]
        n = self.first[k + 1] - self.first[k]
        item = self.owner[np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        at = np.repeat(at, n)
        # item by item, further apart than any reach
        line = np.sort(item * (len(h) + 4 * SHORT) + at)
        item = line // (len(h) + 4 * SHORT)
        around = np.searchsorted(line, line + self.reach[item], "right") - np.searchsorted(line, line - self.reach[item])
        there = around >= self.meet[item]
        return (line - item * (len(h) + 4 * SHORT))[there], item[there]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _near(groups: np.ndarray, wanted: np.ndarray, cosine: float, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, cosine) of the passages near an item, by item; a passage is two neighbouring groups of blocks, half overlapping the next.

    Each text has so many passages from its first group on; others reach over its end.
    """
    least = np.full(len(groups), np.inf, np.float32)
    least[np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)] = cosine
    found = []
    for k in range(0, len(groups), 2048):
        x, after = groups[k : k + 2048].copy(), groups[k + 1 : k + 2049]
        x[: len(after)] += after
        norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), np.float32(1e-9))
        near = x @ wanted.T
        w, j = np.divmod(np.flatnonzero(near >= (norm * least[k : k + 2048])[:, None]), len(wanted))
        found.append((w + k, j, near[w, j] / norm[w]))
    w, j, near = map(np.concatenate, zip(*found))
    order = np.argsort(j, kind="stable")
    return w[order], j[order], near[order]


def search(h: np.ndarray, counts: np.ndarray, basis: np.ndarray, bench: Benchmark, cosine: float = COSINE) -> list[tuple[int, int, int, int, float, bool]]:
    """(text, item, common words, item words, cosine, answer found) of each leak in a run of texts."""
    full = np.flatnonzero(counts)
    if not len(full):
        return []
    sizes = counts[full]
    at = np.cumsum(sizes) - sizes
    blocks = -(-sizes // STEP)
    f = features(h)
    # each text begins at a multiple of the widest half passage, and one without words follows it
    widest = max((s // STEP // 2 for s in bench.scales), default=1)
    room = (-(-blocks // widest) + 1) * widest
    first = np.cumsum(room) - room
    grid = _laid_out(f, sizes, room * STEP).reshape(-1, STEP)
    sums = np.empty((len(grid), basis.shape[1]), np.float32)
    for k in range(0, len(grid), 512):  # the gathered vectors stay in the cache
        part, out = grid[k : k + 512], sums[k : k + 512]
        out[:] = basis.take(part[:, 0], axis=0)
        for j in range(1, STEP):
            out += basis.take(part[:, j], axis=0)
    halves = {1: sums}
    while (w := max(halves)) < widest:
        halves[2 * w] = halves[w][::2] + halves[w][1::2]
    best: dict[tuple[int, int], tuple] = {}
    known = np.full(DIM, -1, np.int32)

    def verify(i: int, t: np.ndarray, a: np.ndarray, b: np.ndarray, cosines: Callable[[int], float]) -> None:
        """Compares item i with the words a to b of each text t."""
        item, n = bench.items[i], len(bench.items[i].words)
        for p in np.flatnonzero(_overlap(item, h, f, a, b, known) >= LIKELY * n):
            key = (int(t[p]), i)
            got = best.get(key)
            if got and got[0] >= 0.95 * n:
                continue
            around = h[a[p] : b[p]].tolist()
            common_words = lcs(item.words, around)
            if got and got[0] >= common_words:
                continue
            there = _stands(item.answer, around)
            if common_words >= SURE * n or common_words >= LIKELY * n and there:
                best[key] = (common_words, n, cosines(p), there)

    for scale, (which, wanted) in bench.scales.items():
        half = scale // STEP // 2
        begin = first // half
        w, j, near = _near(halves[half], wanted, cosine, begin, np.maximum(1, -(-blocks // half) - 1))
        ends = np.flatnonzero(np.r_[j[1:] != j[:-1], True]) + 1 if len(j) else []
        for lo_, hi_ in zip([0, *ends[:-1]], ends):
            i, of = int(which[j[lo_]]), w[lo_:hi_]
            n = len(bench.items[i].words)
            t = np.searchsorted(begin, of, "right") - 1
            lo = (of - begin[t]) * half
            a = np.maximum(at[t], at[t] + lo * STEP - n // 2 - STEP)
            b = np.minimum(at[t] + sizes[t], at[t] + np.minimum(lo + 2 * half, blocks[t]) * STEP + n // 2 + STEP)
            verify(i, t, a, b, lambda p: float(near[lo_ + p]))  # noqa: B023
    place, owner = bench.places(h)
    ends = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True]) + 1 if len(owner) else []
    for lo_, hi_ in zip([0, *ends[:-1]], ends):
        i = int(owner[lo_])
        reach = bench.reach_of(i)
        for k in range(lo_, hi_, 4096):
            where = place[k : min(hi_, k + 4096)]
            t = np.searchsorted(at, where, "right") - 1
            a, b = np.maximum(at[t], where - reach), np.minimum(at[t] + sizes[t], where + reach + 1)
            own = _unit(basis[features(np.array(bench.items[i].words, np.uint64))].sum(0)[None])[0]
            verify(i, t, a, b, lambda p: float(_unit(basis[f[a[p] : b[p]]].sum(0)[None])[0] @ own))  # noqa: B023
    return [(int(full[t]), bench.items[i].id, *b) for (t, i), b in best.items()]


def _overlap(item: Item, h: np.ndarray, f: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Common words of the item and each stretch of words, whatever their order; no subsequence is longer.

    ``known`` holds -1 for each feature. The item's features are numbered there meanwhile, so that other words fall out at once.
    """
    size = b - a
    place = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
    known[item.features] = np.arange(len(item.known))
    at = known[f[place]]
    known[item.features] = -1
    some = np.flatnonzero(at >= 0)
    words, n = h[place[some]], len(item.known)
    at = at[some] if item.apart else np.minimum(np.searchsorted(item.known, words), n - 1)
    hit = item.known[at] == words
    where = np.repeat(np.arange(len(a)), size)[some[hit]]
    found = np.bincount(where * n + at[hit], minlength=n * len(a)).reshape(len(a), n)
    return np.minimum(found, item.counts).sum(1)


def _stands(part: list[int], whole: list[int]) -> bool:
    i, n = -1, len(part)
    while True:
        try:
            i = whole.index(part[0], i + 1)
        except ValueError:
            return False
        if whole[i : i + n] == part:
            return True


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, fit_docs: int | None = None) -> DataFrame:
    """(doc_id, item_id, common_words, item_words, cosine, answer_found): a row for each item that a document leaks.

    Null and empty texts leak nothing, null or empty items are in no document. A
    document whose doc_id is null is searched like others. Repeated documents give
    repeated rows; equal items each give a row; of passages that tie, the first
    counts. An empty table on either side gives no rows. Only doc_id and text,
    item_id and text are read. Very long texts are swept piece by piece; pieces
    overlap by more than the longest item and its surroundings. The basis is fitted on
    all documents; ``fit_docs`` fits it on about so many, picked by a hash of their row.
    """
    return _leaks(docs, benchmark, cosine, fit_docs).drop("row")


LEAKS = "doc_id long, row long, item_id long, common_words long, item_words long, cosine double, answer_found boolean"


def _leaks(docs: DataFrame, benchmark: DataFrame, cosine: float, fit_docs: int | None) -> DataFrame:
    """``leaks`` with the key of each row of ``docs``, in the shared folder."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"), common.row_key().alias("row"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    with common.lean(spark):
        df, n = document_frequencies(d)
    if not n:
        return spark.createDataFrame([], LEAKS)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    fitted = d if fit_docs is None else d.where(common.unit_interval(F.lit(SEED), F.col("row")) <= min(1.0, fit_docs / n))
    with common.lean(spark):
        basis = latent_space(fitted, idf) * idf[:, None]
    basis = np.vstack([basis, np.zeros((1, basis.shape[1]), np.float32)])  # places without a word

    def over(block: list[tuple[int, str]]) -> DataFrame:
        bench = Benchmark(block, basis, idf)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, keys, at = [], batch.column(2).to_pylist(), 0
                for ids, h, counts in _parts(batch):
                    found: dict[tuple[int, int], tuple] = {}
                    for k in range(0, max(1, len(h) - bench.lap), PIECE) if len(counts) == 1 else (0,):
                        size = PIECE + bench.lap
                        piece = (h[k : k + size], np.minimum(counts - k, size)) if len(counts) == 1 else (h, counts)
                        for t, item, *rest in search(*piece, basis, bench, cosine):
                            if (t, item) not in found or found[t, item][0] < rest[0]:
                                found[t, item] = tuple(rest)
                    rows += [(ids[t], keys[at + t], item, *rest) for (t, item), rest in sorted(found.items())]
                    at += len(ids)
                if rows:
                    kinds = [pa.int64()] * 5 + [pa.float64(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "row", "item_id", "common_words", "item_words", "cosine", "answer_found"])

        return scratch.write(d.mapInArrow(run, LEAKS), "leaks")

    blocks = -(-items.count() // ITEMS)
    out = None
    for k in range(blocks):
        part = [(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]
        found = over(part)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], LEAKS)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns; each row is judged by its own text, whatever its doc_id."""
    gone = _leaks(docs, benchmark, COSINE, None).select(F.col("row").alias("__row")).distinct()
    return docs.join(common.few(gone), common.row_key() == F.col("__row"), "left_anti")


def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of ``benchmark`` that each document leaks; edge cases as in ``leaks``."""
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
