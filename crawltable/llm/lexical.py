"""Ranked lexical search of many items at once, sharing what the items have in common.

Items are searched in blocks of a bounded number of terms. For a block the sets of terms
that several items share are mined: terms of the same items stand next to each other, and
pairs of neighbours that come again become a node, over and over. The result is a graph in
which a node is the sum of two others and an item the sum of a few nodes.

All documents are read once per block, into staged rows of their length and of the terms
they share with the block; counts over all documents are taken from those. Then each task
materialises the partial score of every node for some documents at a time, each from the
two nodes below it, adds them up to the scores of the items, and hands on its best rows.
Nothing is pruned or sampled: every document has its score for every item.

Terms are the maximal runs of characters other than ASCII controls, spaces and punctuation,
A-Z in lower case. A null or term-less document counts nowhere; a null or term-less item
finds nothing. Every row of either table is one of its own, so repeated ones are searched
and found several times; equal scores come by ascending document id, null ids last.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawltable.llm.arrow import map_texts
from crawltable.llm.chars import Texts, chunks, sizes_to_offsets, span_hashes
from crawltable.workspace import stage

TOP = 10
# Distinct terms of all items of a block together, on average.
BLOCK_TERMS = 1 << 16
# Partial scores held at a time: nodes times documents.
CELLS = 1 << 22

# Constants of the score.
LENGTH_SHARE, SATURATION, SCALE = 75, 8, 1_000_000_000


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and check of every term of some texts, and the text that each belongs to."""
    laid = Texts(texts)
    codes = laid.codes
    upper = (codes >= 0x41) & (codes <= 0x5A)
    codes = np.where(upper, codes + np.uint32(32), codes)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = (codes >= 0x80) | ((codes >= 0x30) & (codes <= 0x39)) | ((codes >= 0x61) & (codes <= 0x7A))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    return *span_hashes(codes, start, end), laid.owner(start)


def search(
    documents: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's ``top``
    documents with a score above 0."""
    listed = stage(_item_terms(items, item_id, item_text), "items")
    size = listed.agg(F.sum(F.size("hashes"))).first()[0] or 0
    blocks = max(1, -(-size // block_terms))
    found = None
    for n in range(blocks):
        own = listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n)
        best = _search_block(documents, own, top, id, text)
        if best is not None:
            found = best if found is None else found.unionByName(best)
    if found is None:
        found = documents.sparkSession.createDataFrame(
            [], f"item bigint, doc_id {documents.schema[id].dataType.simpleString()}, score bigint, rank int"
        )
    named = listed.select("item", "item_id")
    return found.join(named, "item").select("item_id", "rank", "doc_id", "score")


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct terms of each item and how often each comes; items without any are left out."""

    def make():
        def apply(texts):
            hashes, checks, owner = terms([t or "" for t in texts])
            order = np.lexsort((checks, hashes, owner))
            hashes, checks, owner = hashes[order], checks[order], owner[order]
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(owner) != 0) | (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
            counts = np.diff(np.append(np.flatnonzero(new), len(order)))
            offsets = _offsets(owner[new], len(texts))
            values = (hashes[new].view(np.int64), checks[new].view(np.int64), counts)
            return {
                name: pa.ListArray.from_arrays(offsets, pa.array(v))
                for name, v in zip(("hashes", "checks", "counts"), values)
            }

        return apply

    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("item", F.monotonically_increasing_id())
    added = "hashes array<bigint>, checks array<bigint>, counts array<bigint>"
    return map_texts(rows, make, added).where("size(hashes) > 0")


def _offsets(owner: np.ndarray, n: int) -> pa.Array:
    return pa.array(sizes_to_offsets(np.bincount(owner, minlength=n)), pa.int32())


class Block:
    """The items of a block and the graph of what they share.

    Terms are numbered in the order of their hashes. Nodes 0 to ``len(term) - 1`` are a
    term as often as an item has it (``term``, ``times``); node ``len(term) + n`` is the
    sum of the nodes ``left[n]`` and ``right[n]``, which come before it. The nodes of item
    n are ``roots[starts[n]:starts[n + 1]]``, and ``levels`` are runs of nodes that need
    none of each other.
    """

    def __init__(self, rows: pa.Table):
        lists = rows.column("hashes").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        flat = [rows.column(c).combine_chunks().flatten().to_numpy() for c in ("hashes", "checks", "counts")]
        hashes, checks, counts = flat[0].view(np.uint64), flat[1].view(np.uint64), flat[2]
        item = np.repeat(np.arange(len(sizes)), sizes)
        self.items = rows.column("item").to_numpy()
        pairs, number = np.unique(np.stack((hashes, checks), 1), axis=0, return_inverse=True)
        self.hashes, self.checks = pairs[:, 0].copy(), pairs[:, 1].copy()
        bases, base = np.unique(np.stack((number.ravel(), counts), 1), axis=0, return_inverse=True)
        self.term, self.times = bases[:, 0], bases[:, 1]
        self._mine(base.ravel(), item)

    def _mine(self, node: np.ndarray, item: np.ndarray) -> None:
        # What stands in the same items gets the same signature and so lies together.
        frequency = np.bincount(node)
        mark = np.random.default_rng(0).integers(1 << 62, size=len(self.items))
        signature = np.zeros(len(frequency), np.int64)
        np.bitwise_xor.at(signature, node, mark[item])
        order = np.lexsort((node, signature[node], -frequency[node], item))
        node, item = node[order], item[order]
        left, right, self.levels = [], [], []
        following = len(self.term)
        while len(node) > 1:
            beside = np.flatnonzero(item[1:] == item[:-1])
            pairs, which, counts = np.unique(
                np.stack((node[beside], node[beside + 1]), 1), axis=0, return_inverse=True, return_counts=True
            )
            new, taken = np.full(len(pairs), -1), set()
            first = following
            # Pairs of one item alone are no node, and a node is in one pair at a time.
            for n in np.argsort(-counts, kind="stable")[: int((counts > 1).sum())].tolist():
                a, b = pairs[n].tolist()
                if a not in taken and b not in taken:
                    taken.update((a, b))
                    left.append(a)
                    right.append(b)
                    new[n] = following
                    following += 1
            if following == first:
                break
            self.levels.append((first, following))
            made = new[which.ravel()]
            at = beside[made >= 0]
            node[at] = made[made >= 0]
            kept = np.ones(len(node), bool)
            kept[at + 1] = False
            node, item = node[kept], item[kept]
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        self.roots = node
        self.starts = sizes_to_offsets(np.bincount(item, minlength=len(self.items)))

    @property
    def nodes(self) -> int:
        return len(self.term) + len(self.left)

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Number of each term, -1 where no item has it."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        # Terms with one hash lie next to each other, by their checks.
        while (later := (self.hashes[at] == hashes) & (self.checks[at] < checks) & (at < len(self.hashes) - 1)).any():
            at = at + later
        return np.where((self.hashes[at] == hashes) & (self.checks[at] == checks), at, -1)

    def scores(self, partial: np.ndarray) -> np.ndarray:
        """Items by documents, from the scores of terms by documents."""
        known = np.empty((self.nodes, partial.shape[1]), np.int64)
        np.multiply(partial[self.term], self.times[:, None], out=known[: len(self.term)])
        base = len(self.term)
        for first, end in self.levels:
            own = slice(first - base, end - base)
            np.add(known[self.left[own]], known[self.right[own]], out=known[first:end])
        return np.add.reduceat(known[self.roots], self.starts[:-1], axis=0)


def _search_block(documents: DataFrame, items: DataFrame, top: int, id: str, text: str):
    rows = items.select("item", "hashes", "checks", "counts").toArrow()
    if not rows.num_rows:
        return None
    spark = documents.sparkSession
    block = Block(rows)
    shared = spark.sparkContext.broadcast(block)
    shared_terms = stage(_postings(documents, shared, id, text), "postings")
    total = shared_terms.agg(F.count("*").alias("n"), F.sum("n").alias("size")).first()
    if not total["n"]:
        return None
    frequency = np.zeros(len(block.hashes), np.int64)
    counted = shared_terms.mapInArrow(_document_counts(len(frequency)), "term int, n bigint")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    weights = np.array(
        [math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64
    )
    kind = documents.schema[id].dataType.simpleString()
    scored = shared_terms.select("doc_id", "n", "terms", "times").mapInArrow(
        _ranker(shared, weights, total["n"], total["size"], top), f"item bigint, doc_id {kind}, score bigint"
    )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def _postings(documents: DataFrame, shared, id: str, text: str) -> DataFrame:
    """``n`` terms of each document that has any, and which of the block with their number."""

    def make():
        block = shared.value

        def apply(texts):
            parts = [], [], [], []
            whole = [t or "" for t in texts]
            for part in chunks(whole):
                for own, found in zip(parts, _shared_terms(block, whole[part])):
                    own.append(found)
            n, sizes, numbers, times = map(np.concatenate, parts)
            offsets = pa.array(sizes_to_offsets(sizes), pa.int32())
            lists = (pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (numbers, times))
            return {"n": n, **dict(zip(("terms", "times"), lists))}

        return apply

    rows = documents.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_texts(rows, make, "n bigint, terms array<int>, times array<int>").where("n > 0")


def _shared_terms(block: Block, texts: list[str]):
    hashes, checks, owner = terms(texts)
    n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    number = block.find(hashes, checks)
    known = number >= 0
    key, times = np.unique(owner[known] * len(block.hashes) + number[known], return_counts=True)
    sizes = np.bincount(key // len(block.hashes), minlength=len(texts))
    return n, sizes, key % len(block.hashes), times


def _document_counts(terms: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["term", "n"])

    return count


def _ranker(shared, weights: np.ndarray, documents: int, size: int, top: int):
    """Scores all documents for all items and gives each item's best of a task."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        # One row of terms and the nodes of the graph for each document at a time.
        width = max(1, CELLS // (block.nodes + len(block.roots) + len(weights)))
        best = _Best(len(block.items), top)
        for batch in batches:
            for start in range(0, batch.num_rows, width):
                part = batch.slice(start, width)
                best.add(block.scores(_term_scores(part, weights, documents, size)), part.column("doc_id"))
        items, ids, scores = best.rows()
        if len(items):
            columns = [pa.array(block.items[items]), ids, pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return rank


def _term_scores(part: pa.RecordBatch, weights: np.ndarray, documents: int, size: int) -> np.ndarray:
    n = part.column("n").to_numpy()
    if LENGTH_SHARE * int(n.max()) * documents < 1 << 63:
        norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // size
    else:
        norm = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * k * documents // size for k in n.tolist()], np.int64)
    lists = part.column("terms")
    number, times = lists.flatten().to_numpy(), part.column("times").flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
    scores = np.zeros((len(weights), len(n)), np.int64)
    scores[number, owner] = weights[number] * (SCALE * times // (1000 * times + SATURATION * norm[owner]))
    return scores


class _Best:
    """The ``top`` rows of each item so far, by score and then by id."""

    def __init__(self, items: int, top: int):
        self.top = top
        # A row must reach this to be among the best.
        self.least = np.ones(items, np.int64)
        self.items = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)
        self.ids: pa.Array | None = None

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        items, place = np.nonzero(scores >= self.least[:, None])
        if not len(items):
            return
        own = ids.take(pa.array(place))
        self.ids = own if self.ids is None else pa.concat_arrays([self.ids, own])
        self.items = np.concatenate((self.items, items))
        self.scores = np.concatenate((self.scores, scores[items, place]))
        # Places in the order of the ids, nulls last, stand for the ids themselves.
        by_id = np.empty(len(self.ids), np.int64)
        by_id[pc.array_sort_indices(self.ids).to_numpy()] = np.arange(len(self.ids))
        order = np.lexsort((by_id, -self.scores, self.items))
        owner = self.items[order]
        first = np.searchsorted(owner, owner)
        order = order[np.arange(len(order)) - first < self.top]
        self.items, self.scores, self.ids = self.items[order], self.scores[order], self.ids.take(pa.array(order))
        sizes = np.bincount(self.items, minlength=len(self.least))
        full = np.flatnonzero(sizes == self.top)
        self.least[full] = self.scores[np.cumsum(sizes)[full] - 1]

    def rows(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        return self.items, self.ids, self.scores
