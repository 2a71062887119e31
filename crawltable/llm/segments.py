"""Hard negatives by segment summaries of vectors.

Vectors are cut into segments, and of each the mean and the deviation (the length of what
is left without the mean) are stored beside the vector. For two vectors the products of
the means, times the length of a segment, give their score up to the products of the
deviations. So a pair has bounds from a few numbers: first from long segments, then, if
these leave it open whether the pair can matter, from their halves and quarters, and only
then it is scored exactly.

Anchors are broadcast in blocks of a bounded number of bytes and meet all rows, which
stay where they are. What an anchor needs at least is known from a first pass over all
anchors, which are rows themselves, so a task hands on few rows of each anchor whatever
the number of tasks; further bounds come from the rows that a task has met. Nothing else
is left out: every row is bounded or scored for every anchor.

Rows without an id, a label or a vector, or with a component that is null or not finite,
take no part. Shorter vectors count as filled up with zeros. Every row is one of its own:
copies are other rows than the anchor, and repeated anchors are anchors each.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawltable.workspace import stage

# Components are stored as whole numbers: this times their value, rounded down.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Hundredths of the positive's score that a negative's may have.
LOW, HIGH = 50, 95

# Bytes of the anchors of a block.
BLOCK_BYTES = 32 << 20
# Pairs looked at together.
CELLS = 1 << 21
# Segments of a vector, from the first bound to the last.
LEVELS = (2, 8, 16)
# Open pairs are gathered one by one where less than this share of a block is left.
SPARSE = 1 / 16
# Greatest whole number that floats add up to exactly.
EXACT = float(1 << 53)
LIMIT = np.iinfo(np.int64).max

_POINT = (
    "row bigint, id bigint, label bigint, anchor boolean, vector array<double>, "
    "means array<double>, deviations array<double>"
)


def summarised(df: DataFrame, anchors: Column, id: str, label: str, vector: str) -> DataFrame:
    """Rows that take part, numbered, with their whole components and the means and
    deviations of LEVELS[-1] segments."""
    values = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").cast("bigint").alias("id"),
        F.when(F.col(f"`{label}`").isNotNull(), F.xxhash64(f"`{label}`")).alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), values.alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    # Zeros at the end make all segments equally long and change no score.
    width = max(1, -(-longest // LEVELS[-1])) * LEVELS[-1]

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = lists.value_lengths().to_numpy()
            whole = np.zeros((len(sizes), width))
            places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            whole[np.repeat(np.arange(len(sizes)), sizes), places] = np.floor(SCALE * lists.flatten().to_numpy())
            parts = whole.reshape(len(sizes), LEVELS[-1], -1)
            means = parts.mean(axis=2)
            deviations = np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))
            arrays = [batch.column(n) for n in ("row", "id", "label", "anchor")]
            arrays += [_lists(a) for a in (whole, means, deviations)]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _POINT.split(", ")])

    return rows.mapInArrow(summarise, _POINT)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


class Points:
    """Rows of a batch or of a block of anchors, with bounds of every level."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, order: np.ndarray | None = None):
        def column(name):
            values = batch.column(name)
            values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
            if not pa.types.is_list(values.type):
                return values.to_numpy(zero_copy_only=False)
            return values.flatten().to_numpy().reshape(len(values), -1)

        order = slice(None) if order is None else order
        self.row, self.id, self.label = (column(n)[order] for n in ("row", "id", "label"))
        self.vectors = column("vector")[order]
        means, deviations = column("means")[order], column("deviations")[order]
        self.length = np.sqrt((self.vectors**2).sum(axis=1))
        self.means, self.deviations = {}, {}
        for level in LEVELS:
            # Long segments from the short ones in them.
            parts = means.reshape(len(self.row), level, -1)
            size = self.vectors.shape[1] // LEVELS[-1]
            own = parts.mean(axis=2)
            squares = (deviations.reshape(parts.shape) ** 2).sum(axis=2)
            squares += size * ((parts - own[:, :, None]) ** 2).sum(axis=2)
            # Products of means count once for each component.
            self.means[level] = own * np.sqrt(self.vectors.shape[1] // level)
            self.deviations[level] = np.sqrt(squares)


def within(anchors: Points, rows: Points, a: np.ndarray, r: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Pairs of the anchors ``a`` and rows ``r`` with a score from ``low`` to ``high`` (of
    each of these anchors): their places in ``a`` and ``r``, and their scores."""
    slack = 1e-9 * np.outer(anchors.length[a], rows.length[r]) + 1e-3
    # Windows of very great numbers get a little wider; the caller checks them exactly.
    low, high = low - 1e-12 * np.abs(low), np.where(high == LIMIT, np.inf, high + 1e-12 * np.abs(high))
    pairs = None
    for level in LEVELS:
        first, second = (anchors.means[level], anchors.deviations[level]), (rows.means[level], rows.deviations[level])
        if pairs is None:
            centre, spread = (x[a] @ y[r].T for x, y in zip(first, second))
            spread += slack
            open_ = (centre + spread >= low[:, None]) & (centre - spread <= high[:, None])
            if level == LEVELS[0]:
                # Anchors and rows without an open pair need no look at their segments.
                some, other = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
                if not len(some):
                    return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                open_, slack = open_[np.ix_(some, other)], slack[np.ix_(some, other)]
                low, high, a, r = low[some], high[some], a[some], r[other]
                still = open_
            else:
                still &= open_
            if still.mean() < SPARSE or anchors.length[a].max() * rows.length[r].max() >= EXACT:
                pairs = np.nonzero(still)
        else:
            i, j = pairs
            centre, spread = (np.einsum("ij,ij->i", x[a[i]], y[r[j]]) for x, y in zip(first, second))
            spread += slack[i, j]
            kept = (centre + spread >= low[i]) & (centre - spread <= high[i])
            pairs = i[kept], j[kept]
    if pairs is None:
        scores = (anchors.vectors[a] @ rows.vectors[r].T).astype(np.int64)
        i, j = np.nonzero(still & (scores >= low[:, None]) & (scores <= high[:, None]))
        scores = scores[i, j]
    else:
        i, j = pairs
        scores = _pair_products(anchors.vectors[a[i]], rows.vectors[r[j]], anchors.length[a[i]] * rows.length[r[j]])
        kept = ((scores >= low[i]) & (scores <= high[i])).astype(bool)
        i, j, scores = i[kept], j[kept], scores[kept].astype(np.int64)
    return some[i], other[j], scores


def _pair_products(x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers. Sums of their products are at most the
    product of the lengths, which tells whether floats hold them."""
    if length.max(initial=0) < EXACT:
        return np.einsum("ij,ij->i", x, y).astype(np.int64)
    pairs = zip(x.tolist(), y.tolist())
    return np.array([sum(int(p) * int(q) for p, q in zip(a, b)) for a, b in pairs], object)


class Best:
    """The ``top`` rows of each slot so far: greatest scores, then smallest ids.

    ``least`` and ``least_id`` tell what a row has to beat, from the start where another
    pass has found as many rows.
    """

    def __init__(self, slots: int, top: int):
        self.top = top
        self.least = np.full(slots, np.iinfo(np.int64).min)
        self.least_id = np.full(slots, np.iinfo(np.int64).max)
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        better = (score > self.least[slot]) | ((score == self.least[slot]) & (id <= self.least_id[slot]))
        if not better.any():
            return
        slot = np.concatenate((self.slot, slot[better]))
        score = np.concatenate((self.score, score[better]))
        id = np.concatenate((self.id, id[better]))
        order = np.lexsort((id, -score, slot))
        owner = slot[order]
        order = order[np.arange(len(order)) - np.searchsorted(owner, owner) < self.top]
        self.slot, self.score, self.id = slot[order], score[order], id[order]
        sizes = np.bincount(self.slot, minlength=len(self.least))
        full = np.flatnonzero(sizes == self.top)
        last = np.cumsum(sizes)[full] - 1
        self.least[full], self.least_id[full] = self.score[last], self.id[last]


def mine(
    df: DataFrame,
    anchors: Column,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels with ``low`` to ``high`` hundredths of the
    positive's score: anchor_id, positive_id, rank, negative_id and both scores. Equal
    scores come by ascending id."""
    spark = df.sparkSession
    points = stage(summarised(df, anchors, id, label, vector), "points")
    known = points.where("anchor").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    found = None
    if known["n"]:
        blocks = -(-known["n"] * (known["width"] + 4 * sum(LEVELS)) * 8 // block_bytes)
        for n in range(blocks):
            block = points.where("anchor").where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == n).toArrow()
            if block.num_rows:
                best = _mine_block(points, block, positives, negatives, low, high)
                best = stage(best, "negatives") if blocks > 1 else best
                found = best if found is None else found.unionByName(best)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if found is None:
        return spark.createDataFrame([], ", ".join(f"{n} {'int' if n == 'rank' else 'bigint'}" for n in names))
    return found.select(names)


def _mine_block(points: DataFrame, rows: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    context = points.sparkSession.sparkContext
    # By label, so that anchors of one label lie together.
    order = np.argsort(rows.column("label").to_numpy(), kind="stable")
    block = Points(rows, order)
    shared = context.broadcast(block)
    own = points.where("anchor")

    def pass_over(some: DataFrame, slots: "Slots") -> DataFrame:
        return some.mapInArrow(_searcher(shared, context.broadcast(slots)), "slot bigint, id bigint, score bigint")

    def best_of(found: DataFrame, top: int) -> DataFrame:
        first = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)

    slots = Slots(len(block.row), 1, positives, True)
    slots.learn(best_of(pass_over(own, slots), positives).toArrow())
    same = best_of(pass_over(points, slots), positives).toArrow()
    slot, rank = same.column("slot").to_numpy(), same.column("rank").to_numpy()
    score, id = same.column("score").to_numpy(), same.column("id").to_numpy()
    slots = Slots(len(block.row), positives, negatives, False)
    at = slot * positives + rank - 1
    # Scores are whole numbers, so the window of a positive is one of whole numbers too.
    slots.low[at] = [-(-low * s // 100) for s in score.tolist()]
    slots.high[at] = [high * s // 100 for s in score.tolist()]
    slots.learn(best_of(pass_over(own, slots), negatives).toArrow())
    found = best_of(pass_over(points, slots), negatives)
    # One row per slot of the block, as many as are broadcast to search for.
    named = pa.table(
        {"slot": at, "anchor_id": block.id[slot], "positive_id": id, "positive_score": score}
    )
    named = points.sparkSession.createDataFrame(named)
    found = found.select("slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(F.broadcast(named), "slot")


class Slots:
    """What is searched: ``each`` slots per anchor, with the least and greatest scores of
    each, among rows of the anchor's own label or of others."""

    def __init__(self, anchors: int, each: int, top: int, same: bool):
        bounds = np.iinfo(np.int64)
        self.each, self.top, self.same = each, top, same
        # Slots of other labels are closed until their window is set.
        self.low = np.full(anchors * each, bounds.min if same else bounds.max)
        self.high = np.full(anchors * each, bounds.max if same else bounds.min)
        self.least = np.full(anchors * each, bounds.min)
        self.least_id = np.full(anchors * each, bounds.max)

    def learn(self, found: pa.Table) -> None:
        """Take over what a first pass found, where it found as many rows as wanted."""
        slot, rank = found.column("slot").to_numpy(), found.column("rank").to_numpy()
        last = rank == self.top
        self.least[slot[last]] = found.column("score").to_numpy()[last]
        self.least_id[slot[last]] = found.column("id").to_numpy()[last]


def _searcher(shared, wanted):
    """Meets rows with the anchors of a block and gives the best of each slot."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, slots = shared.value, wanted.value
        best = Best(len(slots.low), slots.top)
        best.least, best.least_id = slots.least.copy(), slots.least_id.copy()
        width = max(1, CELLS // len(anchors.row))
        for batch in batches:
            for start in range(0, batch.num_rows, width):
                rows = Points(batch.slice(start, width))
                for label in np.unique(rows.label):
                    first, end = (np.searchsorted(anchors.label, label, side) for side in ("left", "right"))
                    own = np.arange(first, end)
                    if not slots.same:
                        own = np.concatenate((np.arange(first), np.arange(end, len(anchors.row))))
                    if len(own):
                        _meet(anchors, rows, own, np.flatnonzero(rows.label == label), slots, best)
        if len(best.slot):
            columns = [pa.array(c) for c in (best.slot, best.id, best.score)]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "id", "score"])

    return search


def _meet(anchors: Points, rows: Points, a: np.ndarray, r: np.ndarray, slots: Slots, best: Best) -> None:
    at = a[:, None] * slots.each + np.arange(slots.each)
    low = np.maximum(slots.low[at], best.least[at])
    i, j, scores = within(anchors, rows, a, r, low.min(axis=1), slots.high[at].max(axis=1))
    other = anchors.row[a[i]] != rows.row[r[j]]
    i, j, scores = i[other], j[other], scores[other]
    for n in range(slots.each):
        slot = at[i, n]
        fit = (scores >= slots.low[slot]) & (scores <= slots.high[slot])
        best.add(slot[fit], scores[fit], rows.id[r[j[fit]]])
