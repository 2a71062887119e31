"""Repeated passages by MinHash banding of paragraphs.

A paragraph is a line of MIN_WORDS words or more (runs without the ASCII spaces, A-Z in
lower case). Equal paragraphs are one unit, told by 128 hash bits of their words. Units
get bands of minima over their five-word shingles; the bands are tuned for a recall.
Units that share a band are candidates:

* shingles that no other candidate has cannot be common to a pair. Their number bounds
  the similarity a unit can reach; units and pairs that stay below the limit are done;
* each remaining unit is compared with the unit of its bucket that has the fewest such
  shingles (the one nearest to what the copies have in common), and matches are linked;
* components of these links settle most buckets as a whole;
* in a bucket that still has several components, the units outside its largest one are
  compared with all units of other components: pair by pair what the bound leaves where
  the bucket has up to PAIRED units, and else in cells of two blocks of bounded size, whose
  common shingles are counted by products of matrices, so that only links become rows.

So every candidate pair is compared, ruled out by the bound or already in one component:
none is lost, and a bucket of copies of one passage costs about one comparison per unit,
not per pair. Comparisons are exact Jaccard similarities of the shingle sets, a shingle
being told by 64 hash bits.

Of each component the occurrence with the smallest id and place is kept, the others are
removals. Null and empty texts have no paragraph. Repeated rows are occurrences like any
other, null ids come last. Other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawltable.llm.arrow import free_name, slices
from crawltable.llm.chars import RollingHash, Texts, chunks, expand, mixed
from crawltable.llm.components import components
from crawltable.workspace import scratch, stage

MIN_WORDS = 10
SHINGLE_WORDS = 5
SIMILARITY = 0.8

# Units of a bucket whose pairs are made as rows.
PAIRED = 16
# Units and shingles of a block, and shingles whose matrices are held at a time.
BLOCK_UNITS = 1024
BLOCK_SHINGLES = 1 << 20
AT_A_TIME = 2048

PLACED = "text_row bigint, doc_id bigint, paragraph int, start bigint, `end` bigint, n_words int, text string, k1 bigint, k2 bigint"


def tune_bands(
    similarity: float = SIMILARITY, recall: float = 0.999, low: float = 0.4, false: float = 0.33
) -> tuple[int, int]:
    """Fewest minima as (bands, rows) such that a pair of ``similarity`` shares a band
    with probability ``recall`` and one of ``low`` with at most ``false``."""
    fitting = []
    for rows in range(1, 16):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
        if 1 - (1 - low**rows) ** bands <= false:
            fitting.append((bands * rows, bands, rows))
    return min(fitting)[1:]


def repeated_paragraphs(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    row: str | None = None,
) -> DataFrame:
    """Occurrences of paragraphs that have another one: doc_id, paragraph (number of the
    line), start, end, n_words, the kept occurrence of the component as kept_doc_id and
    kept_paragraph, and whether this one is removed. ``row`` names a column that tells rows
    apart, which comes back as text_row."""
    spark = df.sparkSession
    bands, rows = tune_bands(similarity)
    with scratch(spark, "paragraphs") as folder:
        placed = _paragraphs(df, id, text, min_words, bands, rows, row)
        placed = stage(placed.withColumn("row", F.monotonically_increasing_id()), "placed", folder)
        names = [f"b{n}" for n in range(bands)]
        units = placed.groupBy("k1", "k2").agg(
            F.min("row").alias("unit"), *(F.min(b).alias(b) for b in names)
        )
        units = stage(units, "units", folder)
        linked = _linked_units(placed, units, names, similarity, folder)
        parts = components(linked).select(F.col("node").alias("unit"), "component")
        named = units.select("k1", "k2", "unit").join(parts, "unit", "left")
        named = named.select("k1", "k2", F.coalesce("component", "unit").alias("component"))
        named = stage(named, "named", folder)
        found = placed.drop("text", *names).join(named, ["k1", "k2"])
        found = stage(found.drop("k1", "k2"), "found", folder)
        # Null ids last; of repeated rows the first one read.
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "paragraph", "row")
        first = found.groupBy("component").agg(
            F.min(order).alias("kept"), F.count("*").alias("n_occurrences")
        )
        first = stage(first.where("n_occurrences > 1"), "first", folder)
        hits = found.join(first, "component")
        kept = F.col("kept.row") == F.col("row")
        result = hits.select(
            *(["text_row"] if row else []), "doc_id", "paragraph", "start", "end", "n_words",
            F.col("kept.doc_id").alias("kept_doc_id"),
            F.col("kept.paragraph").alias("kept_paragraph"),
            "n_occurrences", (~kept).alias("removed"),
        )
        return stage(result, "repeated")


def remove_repeated(df: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` without the removed paragraphs, those of each row by itself. Staged."""
    row, cut = free_name(df, "row"), free_name(df, "cut")
    with scratch(df.sparkSession, "lines") as folder:
        numbered = stage(df.withColumn(row, F.monotonically_increasing_id()), "numbered", folder)
        repeated = repeated_paragraphs(numbered, id, text, row=row, **options)
        cuts = repeated.where("removed").groupBy("text_row").agg(F.collect_set("paragraph").alias(cut))
        lines = F.split(F.col(f"`{text}`"), "\n")
        kept = F.filter(lines, lambda line, n: ~F.array_contains(F.col(cut), n))
        joined = numbered.join(cuts.withColumnRenamed("text_row", row), row, "left")
        left = F.when(F.col(cut).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(kept, "\n"))
        cleaned = joined.withColumn(text, left).select(*(F.col(f"`{c}`") for c in df.columns))
        return stage(cleaned, "without-lines")


def _paragraphs(df, id, text, min_words, bands, rows, row) -> DataFrame:
    number = F.col(f"`{row}`") if row else F.lit(None).cast("bigint")
    source = df.select(F.col(f"`{id}`").cast("bigint"), F.col(f"`{text}`"), number)
    names = [f"b{n}" for n in range(bands)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in slices(batch.column(1)):
                some = batch.slice(start, length)
                ids = some.column(0).to_pylist()
                texts = [t or "" for t in some.column(1).to_pylist()]
                for part in chunks(texts):
                    own = some.column(2).slice(part.start, part.stop - part.start)
                    yield _measure(ids[part], own, texts[part], min_words, bands, rows, names)

    return source.mapInArrow(run, PLACED + "".join(f", {b} bigint" for b in names))


def _measure(ids, numbers, texts, min_words, bands, rows, names) -> pa.RecordBatch:
    laid = Texts(texts)
    codes = laid.codes + np.where((laid.codes >= 65) & (laid.codes <= 90), 32, 0).astype(np.uint32)
    word_start, word_end = laid.words()
    words = RollingHash(codes).spans(word_start, word_end)
    line_start, line_end = laid.lines()
    first, last = np.searchsorted(word_start, [line_start, line_end])
    owner = laid.owner(line_start)
    number = np.arange(len(line_start)) - np.searchsorted(line_start, laid.starts)[owner]
    chosen = np.flatnonzero(last - first >= min_words)
    first, last, owner = first[chosen], last[chosen], owner[chosen]
    start, end = line_start[chosen] - laid.starts[owner], line_end[chosen] - laid.starts[owner]
    k1 = RollingHash(words).spans(first, last)
    k2 = RollingHash(mixed(words ^ np.uint64(0xA5A5A5A5A5A5A5A5))).spans(first, last)
    counts = last - first - SHINGLE_WORDS + 1
    at = expand(first, counts)
    shingles = RollingHash(words).spans(at, at + SHINGLE_WORDS)
    columns = _bands(shingles, counts, bands, rows)
    lines = [texts[o][s:e] for o, s, e in zip(owner.tolist(), start.tolist(), end.tolist())]
    arrays = [
        numbers.take(pa.array(owner)),
        pa.array([ids[o] for o in owner.tolist()], pa.int64()),
        pa.array(number[chosen].astype(np.int32)),
        pa.array(start.astype(np.int64)),
        pa.array(end.astype(np.int64)),
        pa.array((last - first).astype(np.int32)),
        pa.array(lines, pa.string()),
        *(pa.array(c.view(np.int64)) for c in (k1, k2, *columns)),
    ]
    known = ["text_row", "doc_id", "paragraph", "start", "end", "n_words", "text", "k1", "k2"]
    return pa.RecordBatch.from_arrays(arrays, names=[*known, *names])


def _bands(shingles: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> list[np.ndarray]:
    """A hash per band and paragraph of the minima of its rows."""
    heads = np.cumsum(counts) - counts
    random = np.random.default_rng(8)
    columns = []
    for band in range(bands):
        column = np.full(len(counts), band + 1, np.uint64)
        for _ in range(rows):
            odd, shift = random.integers(0, 1 << 63, 2, dtype=np.uint64)
            values = shingles * (odd | np.uint64(1)) + shift
            values ^= values >> np.uint64(32)
            least = np.minimum.reduceat(values, heads) if len(heads) else values
            column = mixed(column * np.uint64(0x9E3779B97F4A7C15) + least)
        columns.append(column)
    return columns


def _linked_units(placed, units, names, similarity, folder) -> DataFrame:
    """Edges a, b between units: every pair that shares a band and is similar enough is
    an edge or is joined by others."""
    banded = units.select("unit", F.explode(F.array(*names)).alias("bucket"))
    crowded = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = stage(banded.join(stage(crowded, "crowded", folder), "bucket"), "members", folder)
    sets = stage(_shingle_sets(placed, members.select("unit").distinct()), "sets", folder)
    able = stage(_able(sets, similarity, folder), "able", folder)
    members = stage(members.join(able, "unit"), "able_members", folder)

    central = F.struct(F.col("shared") / F.col("size"), -F.col("unit"))
    first = F.max_by(F.struct("unit", "size", "shared"), central)
    leaders = members.groupBy("bucket").agg(first.alias("leader"), F.count("*").alias("n"))
    leaders = stage(leaders.where("n > 1").select("bucket", "leader"), "leaders", folder)
    pairs = members.join(leaders, "bucket").where("unit <> leader.unit")
    pairs = pairs.where(_may_reach(similarity, "size", "shared", "leader.size", "leader.shared"))
    pairs = pairs.select(F.col("unit").alias("a"), F.col("leader.unit").alias("b")).distinct()
    edges = stage(_similar(stage(pairs, "pairs", folder), sets, similarity), "edges", folder)

    parts = components(edges).withColumnRenamed("node", "unit")
    split = members.join(parts, "unit", "left").withColumn("component", F.coalesce("component", "unit"))
    split = stage(split, "split", folder)
    counts = split.groupBy("bucket", "component").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles")
    )
    largest = F.struct("n", "component")
    main = counts.groupBy("bucket").agg(
        F.max_by("component", largest).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("n"),
        _blocks(F.sum("n"), F.sum("shingles")).alias("blocks"),
        _blocks(
            F.sum("n") - F.max("n"), F.sum("shingles") - F.max_by("shingles", largest)
        ).alias("few_blocks"),
    )
    main = stage(main.where("parts > 1").drop("parts"), "main", folder)
    unsettled = stage(split.join(main, "bucket"), "unsettled", folder)
    small = unsettled.where(F.col("n") <= PAIRED)
    few = small.where("component <> main").select(
        "bucket", F.col("unit").alias("one"), F.col("component").alias("part"),
        F.col("size").alias("size_1"), F.col("shared").alias("shared_1"),
    )
    meets = (small.bucket == few.bucket) & (F.col("component") != F.col("part"))
    meets &= _may_reach(similarity, "size", "shared", "size_1", "shared_1")
    rest = small.join(few, meets).select(
        F.greatest("unit", "one").alias("a"), F.least("unit", "one").alias("b")
    )
    rest = stage(rest.distinct(), "rest", folder)
    found = _linked_in_cells(unsettled.where(F.col("n") > PAIRED), sets, similarity)
    return edges.unionByName(_similar(rest, sets, similarity)).unionByName(found)


def _blocks(units, shingles):
    return F.ceil(F.greatest(units / BLOCK_UNITS, shingles / BLOCK_SHINGLES, F.lit(1))).cast("bigint")


def _linked_in_cells(crowd: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links a, b between units outside their bucket's largest component and units of other
    components, one at least of every two components in a cell that have any.

    A cell has one block of the former and one of all units, so it is bounded, and a bucket of
    any size is spread over its cells."""
    cells = F.expr("""
        concat(
          transform(sequence(0L, few_blocks - 1), i -> struct(i, pmod(xxhash64(unit), blocks) AS j, false AS few)),
          transform(
            filter(sequence(0L, blocks - 1), j -> component <> main),
            j -> struct(pmod(xxhash64(unit), few_blocks) AS i, j, true AS few)))
    """)
    placed = crowd.withColumn("cell", F.explode(cells)).select("bucket", "unit", "component", "cell.*")
    held = placed.join(sets.select("unit", "shingles"), "unit")

    def links(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        unit, component = (cell.column(c).to_numpy() for c in ("unit", "component"))
        lists = cell.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        _, known, often = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        # A shingle that comes once in the cell is common to no pair.
        number = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[known]
        owner = np.repeat(np.arange(len(unit)), sizes)
        order = np.argsort(number, kind="stable")
        number, owner = number[order], owner[order]
        side = cell.column("few").to_numpy()
        one, two = np.flatnonzero(side), np.flatnonzero(~side)
        common = np.zeros((len(one), len(two)), np.float32)
        for first in range(0, int(often[often > 1].size), AT_A_TIME):
            low, high = np.searchsorted(number, [first, first + AT_A_TIME])
            matrix = np.zeros((len(unit), AT_A_TIME), np.float32)
            matrix[owner[low:high], number[low:high] - first] = 1
            common += matrix[one] @ matrix[two].T
        good = common >= similarity * (sizes[one][:, None] + sizes[two] - common.astype(np.float64))
        good &= component[one][:, None] != component[two]
        a, b = np.nonzero(good)
        a, b = one[a], two[b]
        _, chosen = np.unique(np.stack((component[a], component[b])), axis=1, return_index=True)
        return pa.table({"a": unit[a[chosen]], "b": unit[b[chosen]]})

    return held.groupBy("bucket", "i", "j").applyInArrow(links, "a bigint, b bigint")


def _shingle_sets(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """Sorted hashes of the shingles of each chosen unit, as bytes, and their number."""
    texts = placed.select("row", "text").join(chosen, F.col("row") == F.col("unit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, length in slices(whole.column(1)):
                batch, sets = whole.slice(start, length), []
                for text in batch.column(1).to_pylist():
                    laid = Texts([text])
                    codes = laid.codes + np.where((laid.codes >= 65) & (laid.codes <= 90), 32, 0).astype(np.uint32)
                    words = RollingHash(codes).spans(*laid.words())
                    at = np.arange(len(words) - SHINGLE_WORDS + 1)
                    sets.append(np.unique(RollingHash(words).spans(at, at + SHINGLE_WORDS)).view(np.int64))
                sizes = [len(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int32()), pa.array(sets, pa.list_(pa.int64()))],
                    names=["unit", "size", "shingles"],
                )

    return texts.select("unit", "text").mapInArrow(run, "unit bigint, size int, shingles array<bigint>")


def _able(sets: DataFrame, similarity: float, folder: str) -> DataFrame:
    """Units that may be similar enough to another one, with the number of their shingles
    that are in another one at all."""
    exploded = sets.select("unit", "size", F.explode("shingles").alias("shingle"))
    common = exploded.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    common = stage(common, "common", folder)
    shared = exploded.join(common, "shingle").groupBy("unit", "size").agg(F.count("*").alias("shared"))
    return shared.where(F.col("shared") >= similarity * F.col("size"))


def _may_reach(similarity: float, size_a: str, shared_a: str, size_b: str, shared_b: str):
    """Whether the shared shingles suffice for the similarity, were they all common."""
    common = F.least(F.col(shared_a), F.col(shared_b))
    return common >= similarity * (F.col(size_a) + F.col(size_b) - common)


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b whose shingle sets have a Jaccard similarity of at least that."""
    one = sets.select(F.col("unit").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("unit").alias("b"), F.col("shingles").alias("two"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = [], []
            for n in (2, 3):
                lists = batch.column(n)
                places.append(lists.offsets.to_numpy() - lists.offsets[0].as_py())
                values.append(lists.flatten().to_numpy())
            good = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                own, other = (v[p[k] : p[k + 1]] for v, p in zip(values, places))
                merged = np.concatenate((own, other))
                merged.sort()
                common = int((merged[1:] == merged[:-1]).sum())
                good[k] = common >= similarity * (len(merged) - common)
            yield batch.select([0, 1]).filter(pa.array(good))

    return both.mapInArrow(run, "a bigint, b bigint")


def shingle_set(text: str) -> set[tuple]:
    words = text.encode().lower().split()
    return set(zip(*(words[n:] for n in range(SHINGLE_WORDS))))
