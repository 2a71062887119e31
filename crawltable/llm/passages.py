"""Repeated passages, within lines and over line ends as well as whole lines.

Lines of MIN_WORDS words or more are paragraphs: ``paragraphs`` bands them by MinHash, joins
those that collide and verifies their Jaccard similarity. A passage inside lines that differ
otherwise is found in the same way on a smaller scale. Every text is covered by windows of
WINDOW words; the band of a window is the least hash of a run of SEED words in it, and the
least of any REACH neighbouring runs is a seed. Windows that begin STEP words apart around
the seeds which several texts have are joined where all their words are equal. Any MIN_WORDS
words that two texts share have a seed among their first REACH places, and one of these
windows around it lies in what they share; so no such passage is missed.

Windows that overlap in a text are a passage. Passages with a window in common are linked,
and components of the links are clusters, of which the occurrence with the smallest id and
place is kept. Texts with equal words are handled once and counted as often as they come; a
text that comes again is a passage as a whole. What repeats within one text only is none.

Words are runs without the ASCII spaces, A-Z in lower case, and are told by 64-bit hashes.
Null, empty and short texts have no passage. Repeated rows are occurrences like any other,
null ids come last. Other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawltable.llm.arrow import free_name, slices
from crawltable.llm.chars import RollingHash, Texts, chunks, mixed
from crawltable.llm.components import components
from crawltable.llm.paragraphs import SIMILARITY, repeated_paragraphs
from crawltable.workspace import scratch, stage

MIN_WORDS = 50
SEED = 26
# Places of a seed in MIN_WORDS words.
REACH = MIN_WORDS - SEED + 1
STEP = 5
WINDOW = MIN_WORDS - STEP + 1
AROUND = -(-REACH // STEP)

_SCANNED = "row bigint, id bigint, k1 bigint, k2 bigint, at int, seed bigint, windows array<bigint>"


def repeated_passages(
    df: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Occurrences of passages that other texts have as well: doc_id, kind (``line`` or
    ``run``), place (number of the line, or of the run's first word in the text), n_words, the
    kept occurrence of the cluster as kept_doc_id and kept_place, n_occurrences, and whether
    this one is removed."""
    lines = repeated_paragraphs(df, id, text, MIN_WORDS, similarity).select(
        "doc_id", F.lit("line").alias("kind"), F.col("paragraph").alias("place"), "n_words",
        "kept_doc_id", F.col("kept_paragraph").alias("kept_place"), "n_occurrences", "removed",
    )
    spark = df.sparkSession
    with scratch(spark, "passages") as folder:
        texts, hits = _hits(df.withColumn(free_name(df, "row"), F.monotonically_increasing_id()), id, text, folder)
        passages, placed = _merged(hits, folder)
        parts = components(_links(placed, folder)).select(F.col("node").alias("pid"), "component")
        named = passages.join(parts, "pid", "left").withColumn("component", F.coalesce("component", "pid"))
        found = stage(named.join(texts, ["k1", "k2"]).drop("k1", "k2"), "found", folder)
        order = F.struct(F.col("id").isNull(), "id", "start", "row")
        first = found.groupBy("component").agg(F.min(order).alias("kept"), F.count("*").alias("n_occurrences"))
        first = stage(first.where("n_occurrences > 1"), "first", folder)
        kept = (F.col("kept.row") == F.col("row")) & (F.col("kept.start") == F.col("start"))
        runs = found.join(first, "component").select(
            F.col("id").alias("doc_id"), F.lit("run").alias("kind"), F.col("start").alias("place"),
            (F.col("end") - F.col("start")).alias("n_words"), F.col("kept.id").alias("kept_doc_id"),
            F.col("kept.start").alias("kept_place"), "n_occurrences", (~kept).alias("removed"),
        )
        return stage(lines.unionByName(runs), "passages")


def remove_runs(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without runs of words that an earlier text has: of every window that repeats,
    the first occurrence stays whole. Staged."""
    spark = df.sparkSession
    row, cut = free_name(df, "row"), free_name(df, "cut")
    with scratch(spark, "runs") as folder:
        numbered = stage(df.withColumn(row, F.monotonically_increasing_id()), "numbered", folder)
        texts, hits = _hits(numbered, id, text, folder, row)
        placed = stage(hits.join(texts, ["k1", "k2"]).drop("k1", "k2"), "placed", folder)
        order = F.struct(F.col("id").isNull(), "id", "start", "row")
        first = stage(placed.groupBy("window").agg(F.min(order).alias("kept")), "first", folder)
        kept = (F.col("kept.row") == F.col("row")) & (F.col("kept.start") == F.col("start"))
        spans = placed.join(first, "window").select("row", F.struct("start", "end", kept.alias("kept")).alias("span"))
        cuts = spans.groupBy("row").agg(F.collect_set("span").alias(cut)).withColumnRenamed("row", row)
        joined = numbered.join(cuts, row, "left").select(*(F.col(f"`{c}`") for c in (*df.columns, cut)))
        names, place = df.columns, df.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, length in slices(batch.column(place)):
                    some = batch.slice(start, length)
                    pairs = zip(some.column(place).to_pylist(), some.column(len(names)).to_pylist())
                    left = [whole if spans is None else _without(whole, spans) for whole, spans in pairs]
                    columns = list(some.columns[:-1])
                    columns[place] = pa.array(left, columns[place].type)
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        return stage(joined.mapInArrow(run, df.schema), "without-runs")


def _without(text: str, spans: list[dict]) -> str:
    start, end = Texts([text]).words()
    gone, kept = np.zeros(len(start) + 1, bool), np.zeros(len(start) + 1, bool)
    for span in spans:
        (kept if span["kept"] else gone)[span["start"] : span["end"]] = True
    gone &= ~kept
    out, place = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone))))
    for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out.append(text[place : start[first]])
        place = start[last] if last < len(start) else end[last - 1]
    return "".join([*out, text[place:]])


def _hits(df: DataFrame, id: str, text: str, folder: str, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their text's key, and the windows of keys that other texts have."""
    row = row or df.columns[-1]
    source = df.select(F.col(f"`{row}`"), F.col(f"`{id}`").cast("bigint"), F.col(f"`{text}`"))
    scanned = stage(source.mapInArrow(_scan, _SCANNED), "scanned", folder)
    texts = scanned.where("seed IS NULL").select("row", "id", "k1", "k2", F.col("at").alias("words"))
    seeds = scanned.where("seed IS NOT NULL")

    def several(some: DataFrame, name: str) -> DataFrame:
        # Of another text, not of a copy of this one.
        ends = some.groupBy(name).agg(F.min("k1").alias("least"), F.max("k1").alias("most"))
        return stage(ends.where("least < most").select(name), f"several-{name}", folder)

    around = seeds.join(several(seeds, "seed"), "seed").select(
        "k1", "k2", "at", F.posexplode("windows").alias("step", "window")
    )
    around = around.where("window IS NOT NULL").select("k1", "k2", (F.col("at") - STEP * F.col("step")).alias("start"), "window")
    around = stage(around.distinct(), "around", folder)
    inside = around.join(several(around, "window"), "window").withColumn("end", F.col("start") + WINDOW)
    copies = texts.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("words").alias("end"))
    copies = copies.where((F.col("n") > 1) & (F.col("end") >= MIN_WORDS))
    whole = copies.select("k1", "k2", F.lit(0).alias("start"), "end", F.xxhash64("k1", "k2").alias("window"))
    return texts, stage(inside.unionByName(whole), "hits", folder)


def _merged(hits: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Passages (pid, key, start, end), and the windows of each."""
    by_start = Window.partitionBy("k1", "k2").orderBy("start", "end")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0)
    run = F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    numbered = stage(hits.withColumn("new", new).withColumn("run", run).drop("new"), "numbered", folder)
    passages = numbered.groupBy("k1", "k2", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    passages = stage(passages.withColumn("pid", F.monotonically_increasing_id()), "merged", folder)
    placed = numbered.select("k1", "k2", "run", "window").join(passages.select("k1", "k2", "run", "pid"), ["k1", "k2", "run"])
    return passages.drop("run"), stage(placed.select("pid", "window").distinct(), "windows", folder)


def _links(placed: DataFrame, folder: str) -> DataFrame:
    least = stage(placed.groupBy("window").agg(F.min("pid").alias("b")), "least", folder)
    return placed.join(least, "window").where("pid <> b").select(F.col("pid").alias("a"), "b").distinct()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, length in slices(batch.column(2)):
            some = batch.slice(start, length)
            texts = [t or "" for t in some.column(2).to_pylist()]
            for part in chunks(texts):
                own = some.slice(part.start, part.stop - part.start)
                yield _measured(own.column(0), own.column(1), texts[part])


def _measured(rows: pa.Array, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """A row for each text, with its number of words, and for each seed, with its windows."""
    laid = Texts(texts)
    codes = laid.codes + np.where((laid.codes >= 65) & (laid.codes <= 90), 32, 0).astype(np.uint32)
    word_start, word_end = laid.words()
    words = RollingHash(codes).spans(word_start, word_end)
    first, last = np.searchsorted(word_start, [laid.starts, laid.ends])
    rolling = RollingHash(words)
    k1 = rolling.spans(first, last).view(np.int64)
    k2 = RollingHash(mixed(words ^ np.uint64(0xA5A5A5A5A5A5A5A5))).spans(first, last).view(np.int64)
    long = np.flatnonzero(last - first >= MIN_WORDS)
    seeds = [np.zeros(0, np.int64)]
    for n in long.tolist():
        at = np.arange(first[n], last[n] - SEED + 1)
        runs = np.lib.stride_tricks.sliding_window_view(rolling.spans(at, at + SEED), REACH)
        seeds.append(np.unique(runs.argmin(axis=1) + np.arange(len(runs))) + first[n])
    owner = np.repeat(long, [len(s) for s in seeds[1:]])
    seeds = np.concatenate(seeds)
    starts = seeds[:, None] - STEP * np.arange(AROUND)
    inside = (starts >= first[owner, None]) & (starts + WINDOW <= last[owner, None])
    windows = np.zeros(starts.shape, np.int64)
    windows[inside] = rolling.spans(starts[inside], starts[inside] + WINDOW).view(np.int64)
    every = np.concatenate((np.arange(len(texts)), owner))
    sizes = np.concatenate((last - first, seeds - first[owner]))
    hashes = np.concatenate((np.zeros(len(texts), np.int64), rolling.spans(seeds, seeds + SEED).view(np.int64)))
    none = np.arange(len(every)) < len(texts)
    offsets = np.concatenate((np.zeros(len(texts), np.int32), np.arange(len(seeds) + 1, dtype=np.int32) * AROUND))
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(windows.ravel(), mask=~inside.ravel()))
    arrays = [
        rows.take(pa.array(every)), ids.take(pa.array(every)), pa.array(k1[every]), pa.array(k2[every]),
        pa.array(sizes.astype(np.int32)), pa.array(hashes, mask=none), lists,
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _SCANNED.split(", ")])
