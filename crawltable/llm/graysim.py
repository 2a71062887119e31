"""SimHash near-duplicates by a hierarchical index in Gray order.

Distinct fingerprints are sorted by Gray rank over the cluster, which puts fingerprints
with equal bits next to each other. Each slice of the order is cut into groups with
equal leading bits. The bits that all of a group share form its masked pattern, a node
of the upper index; within a slice the same is repeated, eight nodes under each parent.
A search carries the differences seen so far down the tree: a child adds only those on
bits its parent left open, and a whole group goes as soon as the sum exceeds the limit.

Every fingerprint visits all groups that may hold one within the limit, so no link is
lost. What a task links is reduced to a forest before it is handed on, so neither copies
nor dense groups are expanded into pairs. The upper index has a few rows per task.

Null, empty and word-less texts have fingerprint zero and are linked like any other.
Repeated rows keep a row each. Null ids are allowed; a group's id is the smallest known
one. Other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawltable.llm.arrow import free_name, map_texts
from crawltable.llm.chars import expand
from crawltable.llm.components import components
from crawltable.workspace import stage

SHINGLE_WORDS = 3
SEED = 42
MAX_DIFFERENT = 2

# Distinct fingerprints of a slice at most, where the session has too few partitions.
SLICE_POINTS = 250_000
# Members of a leaf, and children of a node.
LEAF, FANOUT = 16, 8
# Pairs of a search and a node looked at together.
FRONTIER = 1 << 17


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint: the bits set in over half the hashes of the shingles."""
    import xxhash

    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    last = ends[min(words, len(parts)) - 1 :] - 1
    first = (ends - np.diff(ends, prepend=0))[: len(last)]
    digest, step = xxhash.xxh64_intdigest, 1 << 16
    ones = np.zeros(64, np.int64)
    for n in range(0, len(last), step):
        spans = zip(first[n : n + step].tolist(), last[n : n + step].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(last), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and ``fingerprint``, the 64 bits as a signed number."""

    def make():
        def apply(texts):
            values = np.array([simhash(t) for t in texts], np.uint64)
            return {"fingerprint": values.view(np.int64)}

        return apply

    return map_texts(df, make, "fingerprint bigint", text, keep)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: its id, ``fingerprint`` and ``component_id``, the
    smallest id reachable over links of at most MAX_DIFFERENT differing bits."""
    hashed = stage(fingerprints(df, text, [id]), "fingerprints")
    labels = label_fingerprints(hashed, id)
    return hashed.join(labels, "fingerprint").select(id, "fingerprint", "component_id")


def keep_one(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, all columns as they were: that of the
    smallest id (null ids last), then of the smallest hash of its text; of rows that
    share both, any one."""
    keys = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("hash"))
    hashed = stage(fingerprints(keys, "text", ["id", "hash"]), "fingerprints")
    rows = hashed.groupBy("fingerprint", "id", "hash").agg(F.count("*").alias("n"))
    labels = label_fingerprints(hashed, "id", "centre")
    order = F.struct(F.col("id").isNull(), "id", "hash", "n")
    kept = rows.join(labels, "fingerprint").groupBy("centre").agg(F.min(order).alias("kept"))
    names = [free_name(df, n) for n in ("kept_id", "kept_hash", "kept_n")]
    kept = stage(kept.select("kept.id", "kept.hash", "kept.n").toDF(*names), "kept")
    same = F.col(f"`{id}`").eqNullSafe(F.col(names[0]))
    same &= F.xxhash64(f"`{text}`") == F.col(names[1])
    once = df.join(kept.where(F.col(names[2]) == 1), same, "left_semi")
    several = df.join(kept.where(F.col(names[2]) > 1), same, "left_semi")
    return once.unionByName(several.dropDuplicates([id, text]))


def label_fingerprints(hashed: DataFrame, id: str, label: str = "component_id") -> DataFrame:
    """``component_id``, or ``centre`` (a fingerprint), of each distinct ``fingerprint``,
    staged."""
    points = stage(hashed.groupBy("fingerprint").agg(F.min(id).alias("least")), "points")
    linked = components(links(points))
    centre = F.coalesce("component", "fingerprint").alias("centre")
    placed = points.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    placed = stage(placed.select("fingerprint", "least", centre), "placed")
    if label == "centre":
        return placed.select("fingerprint", "centre")
    least = placed.groupBy("centre").agg(F.min("least").alias("component_id"))
    least = stage(least, "least")
    return stage(placed.join(least, "centre").select("fingerprint", "component_id"), "labels")


def gray_rank(fingerprint: str):
    """Place in Gray order, shifted so that the signed order is that of the ranks."""
    rank = F.col(fingerprint)
    for bits in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, bits))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def links(points: DataFrame, limit: int = MAX_DIFFERENT) -> DataFrame:
    """Edges a, b that join all distinct fingerprints within ``limit`` bits: a forest of
    each task's links, with the same components as all links."""
    spark = points.sparkSession
    n = points.count()
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SLICE_POINTS))
    lead = max(1, slices.bit_length())
    # A group: leading bits within a slice, so that it is never larger than a slice.
    ranked = points.select("fingerprint", gray_rank("fingerprint").alias("rank"))
    sliced = ranked.repartitionByRange(slices, "rank").select(
        "fingerprint",
        F.spark_partition_id().alias("slice"),
        F.shiftrightunsigned("fingerprint", 64 - lead).alias("lead"),
    )
    sliced = stage(sliced, "slices")
    groups = sliced.groupBy("slice", "lead").agg(
        F.bit_and("fingerprint").alias("ones"), F.bit_or("fingerprint").alias("any")
    )
    # Few rows per slice; the slices are as many as the tasks of a stage.
    upper = [tuple(r) for r in groups.collect()]
    upper.sort()
    index = np.array([(r[2] & _ALL, r[3] & _ALL) for r in upper], np.uint64).reshape(-1, 2)
    place = {(r[0], r[1]): n for n, r in enumerate(upper)}
    top = spark.sparkContext.broadcast((index, place))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (nodes, own), tree = top.value, Tree(*top.value[0].T)
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            slice_, lead_ = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            home = np.array([own[k] for k in zip(slice_, lead_)], np.int64)
            for first in range(0, len(values), 4096):
                some = slice(first, first + 4096)
                for query, node in tree.search(values[some], limit):
                    node = tree.order[node]
                    later = node > home[some][query]
                    yield _routed(node[later], values[some][query[later]], False)
                yield _routed(home[some], values[some], True)

    routed = sliced.mapInArrow(route, "node bigint, member boolean, fingerprint bigint")
    tasks = max(slices, spark.sparkContext.defaultParallelism)
    met = routed.repartition(tasks, "node").sortWithinPartitions("node", F.desc("member"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, members, tree = None, [], None
        for now, kind, values in _runs(batches):
            if now != node:
                if tree is None:  # a node that nobody else visits
                    yield from _linked(_tree(members), np.concatenate(members or [[]]), limit)
                node, members, tree = now, [], None
            if kind:
                members.append(values)
                continue
            if tree is None:
                tree = _tree(members)
                yield from _linked(tree, np.concatenate(members), limit)
            yield from _linked(tree, values, limit)
        if tree is None:
            yield from _linked(_tree(members), np.concatenate(members or [[]]), limit)

    return met.mapInArrow(meet, "a bigint, b bigint")


_ALL = (1 << 64) - 1


def _routed(nodes: np.ndarray, values: np.ndarray, member: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(nodes.astype(np.int64)),
            pa.array(np.full(len(nodes), member)),
            pa.array(values.view(np.int64)),
        ],
        names=["node", "member", "fingerprint"],
    )


def _runs(batches) -> Iterator[tuple[int, bool, np.ndarray]]:
    """Runs of members or of visitors of one node, members first."""
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        kinds = batch.column(1).to_numpy(zero_copy_only=False)
        values = batch.column(2).to_numpy().view(np.uint64)
        cuts = np.flatnonzero((np.diff(nodes) != 0) | (kinds[1:] != kinds[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(nodes)]):
            if start < end:
                yield int(nodes[start]), bool(kinds[start]), values[start:end]


def _tree(members: list[np.ndarray]) -> "Tree":
    whole = np.concatenate(members) if members else np.zeros(0, np.uint64)
    return Tree(whole, whole)


def _linked(tree: "Tree", values: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Edges that join ``values`` with the members within ``limit``."""
    for first in range(0, len(values), 4096):
        some = values[first : first + 4096]
        for query, member in tree.search(some, limit):
            a, b = _forest(some[query], tree.members[member])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"]
            )


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the least member of each component of the links a-b."""
    values, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    one, two = places[: len(a)], places[len(a) :]
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[one], label[two])
        new = label.copy()
        np.minimum.at(new, label[one], least)
        np.minimum.at(new, label[two], least)
        np.minimum.at(new, one, least)
        np.minimum.at(new, two, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    hung = np.flatnonzero(label != np.arange(len(values)))
    return values[hung], values[label[hung]]


class Tree:
    """Index over items in Gray order, each given by its set and its possible bits.

    A plain fingerprint has both equal; a group has the bits all members set and those
    any member sets. Levels run from the root to the leaves; a node knows the bits its
    items share (``mask``, ``pattern``), and which of them are new below its parent.
    """

    def __init__(self, ones: np.ndarray, any_: np.ndarray):
        order = np.argsort(_ranks(ones), kind="stable")
        self.order, self.members = order, ones[order]
        ones, any_ = ones[order], any_[order]
        levels = [(~(ones ^ any_), ones)]
        size = LEAF
        while len(ones) > 1:
            heads = np.arange(0, len(ones), size)
            ones = np.bitwise_and.reduceat(ones, heads)
            any_ = np.bitwise_or.reduceat(any_, heads)
            levels.append((~(ones ^ any_), ones))
            size = FANOUT
        self.levels = []  # from the root: pattern, new bits, items per node above
        above, previous = np.zeros(1, np.uint64), 0
        for n, (mask, pattern) in enumerate(reversed(levels)):
            fan = 1 if n == 0 else LEAF if n == len(levels) - 1 else FANOUT
            parents = np.repeat(above, fan)[: len(mask)] if n else np.zeros(len(mask), np.uint64)
            self.levels.append((pattern, mask & ~parents, fan))
            above = mask

    def search(self, queries: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a query's place and an item's place within ``limit`` differences, as
        blocks; the item's place is in Gray order."""
        if len(self.members) and len(queries):
            n = len(queries)
            start = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.uint8)
            yield from self._descend(0, queries, *start, limit)

    def _descend(self, depth, queries, query, node, differences, limit):
        pattern, new, _ = self.levels[depth]
        differences = differences + np.bitwise_count((queries[query] ^ pattern[node]) & new[node])
        near = differences <= limit
        query, node, differences = query[near], node[near], differences[near]
        if not len(query):
            return
        if depth == len(self.levels) - 1:
            yield query, node
            return
        below, fan = len(self.levels[depth + 1][0]), self.levels[depth + 1][2]
        step = max(1, FRONTIER // fan)
        for n in range(0, len(query), step):
            part = slice(n, n + step)
            counts = np.minimum(fan, below - node[part] * fan)
            yield from self._descend(
                depth + 1,
                queries,
                np.repeat(query[part], counts),
                expand(node[part] * fan, counts),
                np.repeat(differences[part], counts),
                limit,
            )


def _ranks(codes: np.ndarray) -> np.ndarray:
    codes = codes.copy()
    for bits in (1, 2, 4, 8, 16, 32):
        codes ^= codes >> np.uint64(bits)
    return codes
