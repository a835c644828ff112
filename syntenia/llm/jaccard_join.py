"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document is the set of its five-word shingles; two link when their Jaccard
similarity is at least 80 %. Equal sets are one node from the start.

Sizes fall into bands. In a band whose largest size is L, two linked sets differ
in at most H = 2 * L // 9 shingles. The shingle universe is cut into
m = H + 1 + E segments by hash; H differences spoil at most H segments, so
linked sets agree in E + 1 of them. A node indexes a subset of its segments:
empty ones and those whose index list turns out long (more than ``CROWD`` nodes)
are left out. A node that leaves out at most E of them misses no partner.

Nodes that leave out more (members of large groups of copies, texts that are
mostly shared passages, sets that leave segments empty) are joined among
themselves: with m' = H // 2 + 1 + E' segments, E' + 1 have at most one
difference, so full segments are indexed with their one-deletion neighbourhoods.
Segments of fewer than two shingles and segments with a crowded list may again
be left out, up to E' of them.

The few nodes that leave out more even so are bound to crowds. They are joined by
the partition's finest form, single shingles, and the cheapest subset of them: at
most a fifth of a set is missing from a linked one, so of the fifth (and one more)
that fewest nodes hold, in one order for all, linked sets share one, and the first
they share stands in both subsets. The allocation is by cost: one entry for each
segment where that is enough, neighbourhoods and single shingles only for the nodes
that need them.

An index list yields one star of candidates first; once components are known, only
members of different components are compared. Nodes that first meet in a crowded
list share no shingle that few nodes hold, so they differ in all of those. A crowd
that its star leaves in many components is cut into tiles by size and hash; sketches
and the numbers of such shingles are compared inside a pair of tiles, so rows arise for
likely partners only, however many texts of the crowd are just below the threshold.

Candidates that parity sketches don't exclude (the bits in which two sketches
differ are never more than the shingles in which the sets do) are verified exactly:
each set is sent once to each partner it is compared with, beside which it stands
sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.llm import common
from syntenia.llm.components import components
from syntenia.llm.shingles import mixed, set_id, shingle_sets

PERCENT = 80
RATIO = 1.6
CROWD = 8
SLICE = 256
#: Bits of a parity sketch, as powers of two; between them, four to eight for each shingle.
LEAST_BITS, MOST_BITS = 8, 16
#: Sets that one task compares with a leader before another task takes over.
BESIDE = 512
#: Members of a crowd whose sketches are compared with those of as many others at once.
TILE = 256
#: Bytes of an Arrow batch that carries whole sets.
SENT = 4 << 20
#: Stands for a null doc_id, so that it comes last.
NO_ID = (1 << 63) - 1


def _edges() -> list[int]:
    out = [4]
    while out[-1] < 1 << 40:
        out.append(int(out[-1] * RATIO) + 1)
    return out


EDGES = _edges()


def bands_of(size: int) -> list[int]:
    """The band of a size, and the next one if a partner may be in it."""
    k = int(np.searchsorted(EDGES, size))
    return [k, k + 1] if PERCENT * (EDGES[k] + 1) <= 100 * size else [k]


def differences(band: int) -> int:
    """The most shingles in which linked sets of the band differ."""
    return EDGES[band] * 2 * (100 - PERCENT) // (100 + PERCENT)


def plain_parts(band: int) -> tuple[int, int]:
    """Segments, and how many a node may leave out."""
    h = differences(band)
    e = -(-(h + 1) // 4) + 1
    return h + 1 + e, e


def deletion_parts(band: int) -> tuple[int, int]:
    h = differences(band)
    e = -(-h // 4)
    return h // 2 + 1 + e, e


def _cut(tokens: np.ndarray, band: int, m: int, salt: int):
    """Tokens by segment: sorted mixed tokens, starts, segment numbers, sums."""
    t = mixed(tokens + np.uint64(salt + 1315423911 * band))
    seg = (t % np.uint64(m)).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    seg, t = seg[order], t[order]
    starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    return t, starts, seg[starts], np.add.reduceat(t, starts)


def _key(sums: np.ndarray, seg: np.ndarray, band: int, salt: int) -> np.ndarray:
    return mixed(sums + mixed(seg.astype(np.uint64) + np.uint64(salt + 40503 * (band + 1)))).view(np.int64)


def plain_keys(tokens: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """Keys of the segments that hold shingles; how many of them may still be left out (below 0: too few)."""
    m, e = plain_parts(band)
    _, _, seg, sums = _cut(tokens, band, m, 1)
    return _key(sums, seg, band, 1), e - (m - len(seg))


def deletion_keys(tokens: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys of segments and of segments less one shingle, their segments, and how many more may be left out.

    Below 0: too many segments are small.
    """
    m, e = deletion_parts(band)
    t, starts, seg, sums = _cut(tokens, band, m, 2)
    sizes = np.diff(np.r_[starts, len(t)])
    at = np.repeat(np.arange(len(seg)), sizes)
    some = sizes[at] > 1
    less = _key((sums[at] - t)[some], seg[at][some], band, 2)
    return np.concatenate([_key(sums, seg, band, 2), less]), np.concatenate([seg, seg[at][some]]), e - (m - int((sizes > 1).sum()))


def _sets_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    i = batch.schema.get_field_index("text")
    for k in range(0, batch.num_rows, SLICE):
        yield from shingle_sets(batch.column(i).slice(k, SLICE).to_pylist())


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [(len(s), set_id(s)) for s in _sets_of(b)]
        n = pa.array([x[0] for x in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[1] for x in sets], pa.int64()), n], ["doc_id", "row", "node", "n_shingles"])


def _plain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, tag) of every node; tag: band and how many segments may be left out."""
    seen: set[int] = set()
    for b in batches:
        keys, nodes, tags, n = [], [], [], 0
        for s in _sets_of(b):
            if len(s) == 0 or (node := set_id(s)) in seen:
                continue
            if len(seen) > 100_000:
                seen.clear()
            seen.add(node)
            for band in bands_of(len(s)):
                if differences(band):
                    key, spare = plain_keys(s, band)
                    keys.append(key)
                    nodes.append(np.full(len(key), node, np.int64))
                    tags.append(np.full(len(key), (band << 20) + (1 << 19) + max(-1, min(spare, 1 << 18)), np.int32))
                    n += len(key)
            if n > 200_000:
                yield _batch(keys, nodes, tags)
                keys, nodes, tags, n = [], [], [], 0
        if n:
            yield _batch(keys, nodes, tags)


def _batch(keys, nodes, tags) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, tags)], ["key", "node", "tag"])


def _deleted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, band, part, spare) of the nodes that plain segments don't cover."""
    for b in batches:
        bands = b.column(b.schema.get_field_index("bands")).to_pylist()
        for i, s in enumerate(_sets_of(b)):
            node = set_id(s)
            for band in bands[i]:
                key, part, spare = deletion_keys(s, band)
                n = len(key)
                full = lambda x: pa.array(np.full(n, x, np.int32))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(n, node, np.int64)), full(band), pa.array(part.astype(np.int32)), full(spare)], ["key", "node", "band", "part", "spare"])


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(nodes, tags, starts, crowded) of index lists, from rows sorted by key.

    Small lists come together; a crowded one comes in pieces of one start each,
    every piece headed by the list's first node.
    """
    held: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)]
    leader: tuple[int, int, int] | None = None  # of a crowded list that goes on

    def split(key, node, tag):
        """Cut complete lists into crowded and small ones."""
        nonlocal leader
        if not len(key):
            return
        new = np.r_[True, key[1:] != key[:-1]]
        again = np.r_[False, ~new[1:] & (node[1:] == node[:-1])]
        key, node, tag = key[~again], node[~again], tag[~again]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        for i in np.flatnonzero(sizes > CROWD):
            s = slice(starts[i], starts[i] + sizes[i])
            yield node[s], tag[s], np.zeros(1, np.int64), True
        few = sizes <= CROWD
        rows = np.repeat(few, sizes)
        kept = sizes[few]
        if len(kept):
            yield node[rows], tag[rows], np.r_[0, np.cumsum(kept)[:-1]], False

    for b in batches:
        cols = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, (b.column(0), b.column(1), b.column(2)))]
        key = cols[0]
        if leader is not None and len(key):
            n = int(np.searchsorted(key != leader[0], True)) if key[0] == leader[0] else 0
            if n:
                yield np.r_[leader[1], cols[1][:n]], np.r_[np.int32(leader[2]), cols[2][:n]], np.zeros(1, np.int64), True
                cols = [c[n:] for c in cols]
                key = cols[0]
            if len(key):
                leader = None
        if not len(key):
            held = [c[:0] for c in cols]
            continue
        last = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])
        yield from split(*(c[:last] for c in cols))
        held = [c[last:] for c in cols]
        if len(np.unique(held[1])) > CROWD:
            leader = (int(held[0][0]), int(held[1][0]), int(held[2][0]))
            yield from split(*held)
            held = [c[:0] for c in cols]
    yield from split(*held)


def _lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of small lists, or nodes and tags with the number of lists that don't serve them."""
    seen: set[bytes] = set()
    for node, tag, starts, crowded in _groups(batches):
        out, unserved = [], {}
        sizes = np.diff(np.r_[starts, len(node)])
        low = np.ones(len(node), bool) if crowded else (tag & ((1 << 20) - 1)) < (1 << 19)
        if low.any():
            pairs, counts = np.unique(np.stack([node[low], tag[low].astype(np.int64)]), axis=1, return_counts=True)
            if crowded and len(counts):
                counts[:] = 1
            unserved = dict(zip(map(tuple, pairs.T.tolist()), counts.tolist()))
        if not crowded:
            for i in np.flatnonzero(sizes > 1):
                m = np.sort(node[starts[i] : starts[i] + sizes[i]])
                k = m.tobytes()
                if k not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(k)
                    out.append(m)
        rows = len(out) + len(unserved)
        if rows:
            none = [None] * len(unserved)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*out, *none], pa.list_(pa.int64())),
                    pa.array([None] * len(out) + [k[0] for k in unserved], pa.int64()),
                    pa.array([None] * len(out) + [k[1] for k in unserved], pa.int32()),
                    pa.array([None] * len(out) + list(unserved.values()), pa.int64()),
                ],
                ["members", "node", "tag", "hot"],
            )


def _singles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, node, n) of every shingle."""
    for b in batches:
        for s in _sets_of(b):
            full = np.full(len(s), set_id(s), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(full), pa.array(np.full(len(s), len(s), np.int32))], ["token", "node", "n"])


def sketch(tokens: np.ndarray) -> bytes:
    """For each bucket whether an odd number of shingles falls into it."""
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (4 * len(tokens) - 1).bit_length()))
    odd = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """A lower bound of the differences of two sets, from their sketches; the longer one is folded."""
    if len(x) < len(y):
        x, y = y, x
    v, bits = int.from_bytes(x, "little"), 8 * len(x)
    while bits > 8 * len(y):
        bits //= 2
        v = (v >> bits) ^ (v & ((1 << bits) - 1))
    return (v ^ int.from_bytes(y, "little")).bit_count()


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(set_id(s), len(s), sketch(s)) for s in _sets_of(b)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["node", "n", "sketch"])


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that sizes and sketches don't exclude."""
    for b in batches:
        rows = zip(*(b.column(i).to_pylist() for i in range(2, 6)))
        near = [PERCENT * max(n, m) <= 100 * min(n, m) and (100 + PERCENT) * apart(x, y) <= (100 - PERCENT) * (n + m) for n, x, m, y in rows]
        yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(near, pa.bool_())) for i in (0, 1)], ["a", "b"])


def _sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, part, member, node, tokens): each set beside every leader it is compared with, a leader (member 0) beside its members."""
    names = ["a", "part", "member", "node", "tokens"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    for b in batches:
        rows, held = [], 0
        to = b.column(b.schema.get_field_index("beside"))
        for i, s in enumerate(_sets_of(b)):
            node, tokens = set_id(s), s.tobytes()
            for d in to[i].as_py():
                rows.append((d["a"], d["part"], int(d["a"] != node), node, tokens))
                held += len(tokens)
                if held > SENT:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The linked pairs, from rows of ``_sent`` that are sorted so that a leader precedes its members."""
    at, leader = None, np.empty(0, np.uint64)
    for batch in batches:
        out: list[tuple[int, int]] = []
        for a, part, member, node, tokens in zip(*(batch.column(i) for i in range(5))):
            s = np.frombuffer(tokens.as_buffer(), np.uint64)
            who = (a.as_py(), part.as_py())
            if not member.as_py():
                at, leader = who, s.copy()
                continue
            if who != at:
                raise RuntimeError("a set without the leader it is compared with")
            both = int((leader[np.minimum(np.searchsorted(leader, s), len(leader) - 1)] == s).sum())
            if 100 * both >= PERCENT * (len(leader) + len(s) - both):
                out.append((who[0], node.as_py()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of one document for each row of ``wanted``, which is broadcast only while small."""
    return docs.select("row", "text").join(common.few(wanted, 200_000), "row")


def _crowds(rare: DataFrame) -> DataFrame:
    """(a, b): members b of crowded lists beside their leader, the node that shares most with others.

    A leader may be two lists away: copies that share an edit still follow the original.
    """
    crowded = rare.where(F.col("held") > CROWD).select("token", F.struct("rank", "node").alias("who"))
    head = crowded.groupBy("token").agg(F.max("who").alias("head"))
    best = crowded.join(head, "token").groupBy("who").agg(F.max("head").alias("best"))
    followed = crowded.join(best, "who")
    top = followed.groupBy("token").agg(F.max("best").alias("top"))
    return crowded.join(top, "token").select(F.col("top.node").alias("a"), F.col("who.node").alias("b")).distinct()


def _rare(tokens: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(token, node, held, n, cold, rank): of each node the shared shingles among its fifth, and one more, that fewest hold.

    held: nodes that hold the shingle; cold: shingles of the node that at most CROWD hold; rank: how much the node shares.
    """
    held = scratch.write(tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "held")
    of = Window.partitionBy("node")
    shared = tokens.join(common.few(held), "token").select(
        "*",
        F.row_number().over(of.orderBy("held", "token")).alias("place"),
        F.count("*").over(of).alias("shared"),
        F.sum((F.col("held") > CROWD).cast("int")).over(of).alias("hot"),
        F.sum("held").over(of).alias("rank"),
    )
    fifth = F.floor(F.col("n") * (100 - PERCENT) / 100) + 1
    return shared.where(F.col("n") - F.col("shared") + F.col("place") <= fifth).select("token", "node", "held", "n", (F.col("n") - F.col("hot")).alias("cold"), "rank")


def _classified(docs: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(doc_id, row, n_shingles, first) of each row; first: (id, row) of the class's first document, null without shingles."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.row_key().alias("row"), common.text_or_empty().alias("text"))
    members = scratch.write(d.mapInArrow(_members, "doc_id long, row long, node long, n_shingles long"), "members")
    who = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "row")
    chosen = scratch.write(members.where("n_shingles > 0").groupBy("node").agg(F.min(who).alias("who")), "chosen")

    def texts(nodes: DataFrame) -> DataFrame:
        return _texts(d, scratch.write(nodes.join(chosen.select("node", "who.row"), "node").drop("node"), "wanted"))

    def members_of(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(key).agg(F.array_sort(F.collect_set("node")).alias("members")).where("size(members) > 1").select("members")

    keys = d.select("text").mapInArrow(_plain, "key long, node long, tag int").repartition("key").sortWithinPartitions("key", "node")
    plain = scratch.write(keys.mapInArrow(_lists, "members array<long>, node long, tag int, hot long"), "plain")
    unserved = plain.where("node is not null").groupBy("node", "tag").agg(F.sum("hot").alias("hot"))
    unserved = unserved.where("hot > (tag & 1048575) - 524288").groupBy("node").agg(F.collect_set(F.shiftright("tag", 20)).alias("bands"))

    keys = scratch.write(texts(unserved).mapInArrow(_deleted, "key long, node long, band int, part int, spare int"), "deletions")
    sized = scratch.write(keys.join(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key"), "sized")
    lost = sized.where(F.col("size") > CROWD).groupBy("node", "band").agg(F.count_distinct("part").alias("lost"))
    bound = keys.groupBy("node", "band").agg(F.max("spare").alias("spare")).join(lost, ["node", "band"], "left")
    bound = bound.where(F.coalesce("lost", F.lit(0)) > F.col("spare")).select("node").distinct()

    rare = scratch.write(_rare(scratch.write(texts(bound).mapInArrow(_singles, "token long, node long, n int").distinct(), "shingles"), scratch), "rare")
    lists = plain.where("members is not null").select("members")
    lists = lists.union(members_of(sized.where(F.col("size") <= CROWD), "key")).union(members_of(rare.where(F.col("held") <= CROWD), "token")).distinct()
    lists = scratch.write(lists.withColumn("list", F.monotonically_increasing_id()), "lists")
    crowds = scratch.write(_crowds(rare), "crowds")
    star = lists.select(F.col("members")[0].alias("a"), F.explode(F.slice("members", 2, F.size("members"))).alias("b"))
    pairs = scratch.write(crowds.where("a != b").union(star).distinct(), "pairs")

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sketches = scratch.write(texts(nodes).mapInArrow(_sketches, "node long, n int, sketch binary"), "sketches")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that link."""
        side = lambda k: sketches.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"sketch_{k}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b")
        near = scratch.write(near.mapInArrow(_near, "a long, b long").distinct(), f"{name}-near")
        parts = F.ceil(F.col("size") / BESIDE).cast("int")
        near = near.join(near.groupBy("a").agg(F.count("*").alias("size")), "a").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"))
        beside = near.select(F.col("b").alias("node"), "a", "part").union(near.select(F.col("a").alias("node"), "a", "part").distinct())
        beside = beside.groupBy("node").agg(F.collect_list(F.struct("a", "part")).alias("beside"))
        rows = texts(beside).mapInArrow(_sent, "a long, part int, member int, node long, tokens binary")
        rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "member")
        return scratch.write(rows.mapInArrow(_compared, "a long, b long").distinct(), name)

    def rooted(links: DataFrame) -> DataFrame:
        """(node, root) by links; root: (id, row) of the first document."""
        for k in ("a", "b"):
            links = links.join(chosen.select(F.col("node").alias(k), F.col("who").alias(f"who_{k}")), k)
        roots = components(links.select(F.col("who_a").alias("a"), F.col("who_b").alias("b")), scratch)
        return scratch.write(chosen.join(roots.withColumnRenamed("node", "who"), "who").select("node", "root"), "roots")

    first = linked(pairs, "links")
    roots = rooted(first)
    marks = rare.where(F.col("held") > CROWD).select("node", "n", "cold").distinct()
    more = _across_lists(lists, roots).union(_across_crowds(crowds, marks, roots, sketches, scratch)).distinct()
    for x, y in (("a", "b"), ("b", "a")):
        more = more.join(pairs.select(F.col(x).alias("a"), F.col(y).alias("b")), ["a", "b"], "left_anti")
    second = linked(scratch.write(more, "more"), "links-across")
    roots = rooted(first.union(second)) if not second.isEmpty() else roots
    scratch.keep(members, chosen, roots)
    of_node = chosen.join(roots, "node", "left").select("node", F.coalesce("root", "who").alias("first"))
    return members.join(of_node, "node", "left").select("doc_id", "row", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("first")).alias("first"))


def classes(docs: DataFrame, scratch: common.Scratch | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable by links. Null and empty texts
    have no shingles and link with nothing (component_id is their own id). Equal
    sets are linked whatever the texts. Rows whose doc_id is null take part like
    others; component_id is null only where all of a class are so. Rows that share a
    doc_id but not the text are documents of their own. Repeated rows give a row
    each; an empty table gives no rows; other columns are not read. Shingles are
    64-bit hashes.
    """
    rows = _classified(docs, scratch or common.Scratch(docs.sparkSession))
    least = F.when(F.col("first.id") != NO_ID, F.col("first.id"))
    return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, least).otherwise(F.col("doc_id")).alias("component_id"))


def _rooted(rows: DataFrame, roots: DataFrame, key: str = "node") -> DataFrame:
    """Rows with the component of a node; a node without links is named by itself."""
    found = roots.select(F.col("node").alias(key), F.col("root.row").alias("root"))
    return rows.join(found, key, "left").withColumn("root", F.coalesce("root", key))


def _across_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of one small list that are in different components (a list has at most CROWD members)."""
    rows = _rooted(lists.select("list", F.explode("members").alias("node")), roots)
    open_ = rows.groupBy("list").agg(F.collect_list(F.struct("node", "root")).alias("m")).where("size(array_distinct(transform(m, x -> x.root))) > 1")
    rows = open_.select(F.posexplode("m").alias("i", "x"), "m").select("x", F.explode(F.expr("filter(slice(m, i + 2, size(m)), y -> y.root != x.root)")).alias("y"))
    return rows.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _class_of(n: Column) -> Column:
    """Sizes of linked sets are in one class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")


def _across_crowds(crowds: DataFrame, marks: DataFrame, roots: DataFrame, sketches: DataFrame, scratch: common.Scratch) -> DataFrame:
    """Pairs of one crowd in different components that may link though they share no shingle that few hold.

    Only members outside the leader's component are compared with others.
    """
    v = _rooted(crowds.select(F.col("a").alias("leader"), F.col("b").alias("node")).join(marks, "node"), roots)
    led = _rooted(crowds.select(F.col("a").alias("leader")).distinct(), roots, "leader").withColumnRenamed("root", "leader_root")
    v = v.join(led, "leader").withColumn("out", F.col("root") != F.col("leader_root")).withColumn("class", _class_of(F.col("n")))
    v = scratch.write(v.select("leader", "class", "out", "node", "root", "n", "cold"), "crowd-members")
    open_ = common.few(v.where("out").select("leader").distinct())
    v = v.join(open_, "leader", "left_semi")
    tile = ["leader", "class", "out", "part"]
    sized = v.groupBy("leader", "class", "out").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    v = v.join(common.few(sized), ["leader", "class", "out"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    v = v.join(sketches.select("node", "sketch"), "node")
    tiles = scratch.write(v.groupBy(*tile).agg(F.collect_list(F.struct("node", "root", "n", "cold", "sketch")).alias("members")), "tiles")  # about TILE members
    x = tiles.where("out").select("leader", F.explode(F.array(*[F.col("class") + k for k in (-1, 0, 1)])).alias("class"), F.col("class").alias("x_class"), F.col("part").alias("x_part"))
    # of two tiles outside the leader's component each pair once
    pairs = x.join(tiles.select(*tile), ["leader", "class"]).where("not out or struct(x_class, x_part) <= struct(class, part)")
    first = tiles.where("out").select("leader", F.col("class").alias("x_class"), F.col("part").alias("x_part"), F.col("members").alias("x"))
    both = pairs.join(first, ["leader", "x_class", "x_part"]).join(tiles.withColumnRenamed("members", "y"), tile)
    return both.select("x", "y").mapInArrow(_near_tiles, "a long, b long").distinct()


def _tile(members: list[dict]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, sketches) of a tile's members by the length of their sketches; numbers: node, root, n, cold."""
    by: dict[int, list[dict]] = {}
    for m in members:
        by.setdefault(len(m["sketch"]), []).append(m)
    for part in by.values():
        yield np.array([(m["node"], m["root"], m["n"], m["cold"]) for m in part], np.int64), np.array([np.frombuffer(m["sketch"], np.uint64) for m in part])


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Sketches of fewer buckets."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _near_tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of two tiles, of different components, that sizes, cold shingles and sketches don't exclude."""
    for batch in batches:
        found = [np.empty((0, 2), np.int64)]
        for r in range(batch.num_rows):
            xs, ys = list(_tile(batch.column(0)[r].as_py())), list(_tile(batch.column(1)[r].as_py()))
            for (u, x), (v, y) in ((p, q) for p in xs for q in ys):
                words = min(x.shape[1], y.shape[1])
                x_, y_ = _folded(x, words), _folded(y, words)
                for i, (node, root, n, cold) in enumerate(u.tolist()):
                    both, least, most = n + v[:, 2], np.minimum(n, v[:, 2]), np.maximum(n, v[:, 2])
                    differ = cold + v[:, 3] + np.abs(n - cold - v[:, 2] + v[:, 3])
                    may = np.flatnonzero((v[:, 1] != root) & (PERCENT * most <= 100 * least) & ((100 + PERCENT) * differ <= (100 - PERCENT) * both))
                    if len(may):
                        apart_ = np.bitwise_count(x_[i] ^ y_[may]).sum(1, dtype=np.int64)
                        may = may[(100 + PERCENT) * apart_ <= (100 - PERCENT) * both[may]]
                        found.append(np.stack([np.minimum(node, v[may, 0]), np.maximum(node, v[may, 0])], 1))
        out = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates of ``documents``; edge cases as in ``classes``."""
    return classes(common.table(spark, sf_dir, "documents"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one kept of each class: the one with the smallest doc_id.

    Documents without an id come after all others of their class. Rows that repeat
    the kept one's id and text stay with it; unlike texts that share the id of a
    dropped one stay. Documents without words are linked with nothing and stay.
    """
    scratch = common.Scratch(docs.sparkSession)
    rows = _classified(docs, scratch).where("n_shingles > 0 and row != first.row")
    gone = scratch.write(rows.select(F.col("row").alias("__row")).distinct(), "gone")
    scratch.keep(gone)
    return docs.join(common.few(gone), common.row_key() == F.col("__row"), "left_anti")
