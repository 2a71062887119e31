"""Chat formatting in budgeted windows.

Turns are sorted over the cluster by conversation and turn; prefix sums of their tokens,
continued over task borders from one total per task and conversation, give every turn a
cell of ``budget - history`` tokens. A cell, with the turns that may serve it as history
and the system turn, is all that one group holds, however long the conversation is. In a
cell the prefix sums choose spans of whole turns within the budget. Every window starts
with the system turn and up to ``history`` tokens of the turns before it; only assistant
turns that are new in the window are under the loss mask, so each is a target once.

A turn longer than the budget makes a window of its own with ``over_budget`` set: turns
are never cut. The template is ``<|im_start|>role\\ntext<|im_end|>\\n``; ``<|`` inside a
text gets a backslash between its two characters, one more where there are some already,
which is undone when reading back.

Null texts and roles are empty. Turns with equal numbers are ordered by a hash of role and text,
null numbers first; repeated rows are turns like any other; rows with a null
conversation form one conversation. Other columns are not read.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crawltable.llm.arrow import slices
from crawltable.llm.tokens import tokenizer, vocabulary_path
from crawltable.workspace import scratch, stage

BUDGET = 1024
HISTORY = 256
# Tokens of the template around a turn.
FRAME_TOKENS = 4

SYSTEM, EARLIER, NEW = range(3)

WINDOWS = """conv_id bigint, cell bigint, span int, n_turns int, n_repeated int, n_tokens bigint,
  over_budget boolean, formatted string, loss array<struct<start:bigint,end:bigint>>"""


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def turn_head(role: str) -> str:
    role = escape(role).replace("\\", "\\\\").replace("\n", "\\n")
    return f"<|im_start|>{role}\n"


TAIL = "<|im_end|>\n"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of all turns of a window."""

    def role(written):
        plain = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], written)
        return unescape(plain)

    return [(role(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


def format_windows(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    vocabulary: str | None = None,
) -> DataFrame:
    """Windows of all conversations, staged; ``cell`` and ``span`` order those of one.

    ``formatted`` begins with ``n_repeated`` turns that other windows hold too; ``loss``
    has the places (code points) of the texts to learn.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    spark = df.sparkSession
    size = budget - history
    turns = df.select(
        F.col(f"`{conversation}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    with scratch(spark, "chat") as folder:
        placed = _prefix_sums(turns, vocabulary or vocabulary_path(), folder)
        cell = F.floor(F.col("before") / size)
        placed = placed.withColumn("cell", cell)
        columns = ["conv_id", "cell", "kind", "position", "before", "tokens", "role", "text"]
        new = placed.withColumn("kind", F.lit(NEW)).select(columns)
        last = F.floor((F.col("before") + history) / size)
        earlier = placed.where(last > F.col("cell")).withColumns(
            {"kind": F.lit(EARLIER), "cell": F.explode(F.sequence(F.col("cell") + 1, last))}
        )
        systems = placed.where("position = 0 AND role = 'system'")
        cells = placed.groupBy("conv_id").agg(F.max("cell").alias("last")).where("last > 0")
        systems = systems.join(cells, systems.conv_id.eqNullSafe(cells.conv_id)).drop(cells.conv_id)
        systems = systems.withColumns(
            {"kind": F.lit(SYSTEM), "cell": F.explode(F.sequence(F.lit(1).cast("bigint"), "last"))}
        )
        rows = new.unionByName(earlier.select(columns)).unionByName(systems.select(columns))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        grouped = rows.repartition(tasks, "conv_id", "cell")
        grouped = grouped.sortWithinPartitions("conv_id", "cell", "kind", "position")
        arrow = to_arrow_schema(T.StructType.fromDDL(WINDOWS))

        def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, held = [], 0
            for key, group in groupby(_rows(batches), key=lambda r: r[:2]):
                for window in _windows(list(group), budget, history):
                    out.append(dict(zip(arrow.names, (*key, *window))))
                    held += len(window[5])
                if held >= 1 << 20:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)

        return stage(grouped.mapInArrow(assemble, WINDOWS), "windows")


def _prefix_sums(turns: DataFrame, vocabulary: str, folder: str) -> DataFrame:
    """Add ``tokens``, ``position`` (0, 1, ...) and ``before``, the tokens of the
    conversation's earlier turns."""
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges by a hash of the text: their bounds are sampled, and whole texts should not be.
    turns = turns.withColumn("hash", F.xxhash64("role", "text"))
    order = ["conv_id", "turn", "hash"]
    ordered = turns.repartitionByRange(tasks, *order).sortWithinPartitions(*order, "role", "text")
    schema = "conv_id bigint, role string, text string, tokens bigint, position bigint, before bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(vocabulary)
        last, position, before = (), 0, 0
        for batch in batches:
            for start, length in slices(batch.column(3)):
                some = batch.slice(start, length)
                ids, texts = some.column(0).to_pylist(), some.column(3).to_pylist()
                sizes = [len(x) + FRAME_TOKENS for x in words.encode(texts)]
                places, sums = [], []
                for conv, size in zip(ids, sizes):
                    if (conv,) != last:
                        last, position, before = (conv,), 0, 0
                    places.append(position)
                    sums.append(before)
                    position, before = position + 1, before + size
                added = [pa.array(x, pa.int64()) for x in (sizes, places, sums)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), some.column(3), *added],
                    names=["conv_id", "role", "text", "tokens", "position", "before"],
                )

    counted = ordered.mapInArrow(count, schema).withColumn("part", F.spark_partition_id())
    counted = stage(counted, "counted", folder)
    totals = counted.groupBy("conv_id", "part").agg(
        F.count("*").alias("n"), F.sum("tokens").alias("sum")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"),
        F.sum("n").over(earlier).alias("_n"), F.sum("sum").over(earlier).alias("_sum"),
    ).where("_n > 0")
    # Only conversations that go on from an earlier task: at most one per task.
    totals = stage(totals, "totals", folder)
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    joined = counted.join(totals, same, "left").fillna(0, ["_n", "_sum"])
    return joined.select(
        "conv_id", "role", "text", "tokens",
        (F.col("position") + F.col("_n")).alias("position"),
        (F.col("before") + F.col("_sum")).alias("before"),
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _windows(rows: list[tuple], budget: int, history: int) -> Iterator[tuple]:
    """Windows of the turns that are new in a cell: columns of WINDOWS after the key."""
    system = [r for r in rows if r[2] == SYSTEM]
    turns = [r for r in rows if r[2] != SYSTEM]
    new = sum(r[2] == NEW for r in turns)
    if not new:
        return
    first = len(turns) - new
    if turns[0][3] == 0 and turns[0][6] == "system":
        system = system or turns[:1]
    system_tokens = sum(r[5] for r in system)
    ends = np.array([r[4] + r[5] for r in turns])
    starts = ends - np.array([r[5] for r in turns])
    span = 0
    while first < len(turns):
        has_system = bool(system) and turns[first][3] > 0
        fixed = system_tokens if has_system else 0
        end = int(np.searchsorted(ends, starts[first] + budget - fixed, "right"))
        end = max(end, first + 1)
        own = int(ends[end - 1] - starts[first])
        room = min(history, budget - fixed - own)
        back = int(np.searchsorted(starts, starts[first] - max(room, 0)))
        back = min(back, first)
        while has_system and back < first and turns[back][3] == 0:
            back += 1  # the system turn itself stands in front already
        shown = (system if has_system else []) + turns[back:end]
        repeated = len(shown) - (end - first)
        formatted, loss = _formatted(shown, repeated)
        tokens = fixed + int(ends[end - 1] - starts[back])
        yield span, len(shown), repeated, tokens, tokens > budget, formatted, loss
        first, span = end, span + 1


def _formatted(turns: list[tuple], repeated: int) -> tuple[str, list[dict]]:
    parts, loss, place = [], [], 0
    for n, (*_, role, text) in enumerate(turns):
        head, body = turn_head(role), escape(text)
        start = place + len(head)
        if n >= repeated and role == "assistant":
            loss.append({"start": start, "end": start + len(body)})
        parts += [head, body, TAIL]
        place = start + len(body) + len(TAIL)
    return "".join(parts), loss


DIGEST = """conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint,
  loss_sha256 string, formatted_chars bigint, n_windows bigint, n_over_budget bigint"""


def digest(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from them.

    A hash over a whole conversation has to see its windows one after the other: a task
    streams them and holds one window at a time.
    """
    tasks = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = windows.select("conv_id", "cell", "span", "n_repeated", "over_budget", "formatted", "loss")
    ordered = ordered.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "cell", "span")
    arrow = to_arrow_schema(T.StructType.fromDDL(DIGEST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, group in groupby(_rows(batches), key=lambda r: r[0]):
            out.append(dict(zip(arrow.names, (conv, *_digest(group)))))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return ordered.mapInArrow(run, DIGEST)


def _digest(windows: Iterator[tuple]) -> tuple:
    turns, learned = hashlib.sha256(), hashlib.sha256()
    n_turns = loss_chars = chars = n = over = 0
    for _, _, _, repeated, over_budget, formatted, loss in windows:
        for role, text in parse(formatted)[repeated:]:
            turns.update(f"{role}\n{text}\n".encode())
            n_turns += 1
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            learned.update(text.encode())
            loss_chars += len(text)
        chars, n, over = chars + len(formatted), n + 1, over + over_budget
    return n_turns, turns.hexdigest(), loss_chars, learned.hexdigest(), chars, n, over
