"""BPE ids of whole texts by a table of their distinct words, and back.

A vocabulary divides a text into words that it encodes one by one. So the words of all
texts are found first (each task hands on a word once), every distinct word is encoded
once, and the ids are joined back to the places where the words stand.

The join has two sides, and texts are not shuffled by either. Frequent words, ``head_words``
of them at most, are broadcast. Every partition of the texts asks for the other words it
holds, once each; a shuffle joins these with the rest of the table, and the answer lies in
the shared folder where the partition is read again. What is rare is asked for by few
partitions, so no key is hot, and nothing broadcast grows with the corpus. Should a
partition hold other texts when it is read again, words without an answer are encoded anew.

Words are looked up by a 64-bit hash. Words that share one are found when the table is
made, by a second number made of their characters; texts with one are encoded as a whole.

Null texts count as empty and have no ids, repeated rows keep a row each, other columns
are kept as they are, and ids that the vocabulary lacks fail when they are decoded.
"""

import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crawltable.llm.arrow import slices
from crawltable.llm.chars import (
    Texts,
    chunks,
    expand,
    kept_in_process,
    sizes_to_offsets,
    span_hashes,
)
from crawltable.llm.tokens import (
    UNSURE,
    byte_characters,
    character_classes,
    divides_words,
    pieces,
    plain,
    vocabulary_path,
)
from crawltable.sources.archive import open_files
from crawltable.workspace import fresh_path, stage

# Words broadcast at most, of some 30 bytes each.
HEAD_WORDS = 1 << 18
# Ids decoded at a time; a text with more of them comes alone.
DECODED_IDS = 1 << 19
# Distinct words held by a task before it hands them on.
HELD_WORDS = 1 << 19
# Hashes shared by different words that are broadcast; more point to a broken hash.
SHARED_HASHES = 100_000


def splitter(path: str, bits: int = 64) -> "Splitter":
    return kept_in_process(f"splitter {bits} {path}", lambda: Splitter(path, bits))


class Words:
    """The words of some texts, in order: ``hashes``, ``checks`` that tell words with one
    hash apart, the number of words of each text, and a function for the n-th word."""

    def __init__(self, hashes, checks, sizes: np.ndarray, word: Callable[[int], str]):
        self.hashes, self.checks, self.sizes, self.word = hashes, checks, sizes, word


class Splitter:
    """Divides texts into the words that a vocabulary encodes by themselves.

    For the known division of ``tokens`` most texts are divided in numpy; those with
    special tokens or characters of unsure class, and all texts for other vocabularies,
    by the library's own normalizer and pre-tokenizer.
    """

    def __init__(self, path: str, bits: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.numpy = divides_words(rules)
        added = self.whole.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that depend on what stands around them are not supported")
        self.special = {t.content: i for i, t in added.items()}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.pattern = re.compile(f"({'|'.join(names)})") if names else None
        self.divide = self.whole.pre_tokenizer
        self.shown = None
        if self.numpy:
            split = rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
            self.divide = pre_tokenizers.Split(Regex(split), "removed", invert=True)
            self.shown = byte_characters()
            self.classes = character_classes()
        self.mask = np.uint64((1 << bits) - 1)

    def split(self, texts: Sequence[str]) -> Words:
        odd = np.ones(len(texts), bool)
        if self.numpy:
            laid = Texts([plain(text) for text in texts])
            classes = self.classes[laid.codes]
            odd = laid.count(classes == UNSURE) > 0
            if self.pattern:
                found = (bool(self.pattern.search(text)) for text in texts)
                odd |= np.fromiter(found, bool, len(texts))
        rest = np.flatnonzero(odd)
        listed = [self._listed(texts[n]) for n in rest]
        flat = [word for words in listed for word in words]
        own = Texts(flat)
        hashes, checks = self._hashed(own.codes, own.starts, own.ends)
        owner = np.repeat(rest, [len(words) for words in listed])
        if not self.numpy:
            return Words(hashes, checks, np.bincount(owner, minlength=len(texts)), flat.__getitem__)
        start, end = pieces(laid.codes, classes)
        place = laid.owner(start)
        kept = ~odd[place]
        start, end, place = start[kept], end[kept], place[kept]
        joined = "\n".join(laid.texts)

        def word(n: int) -> str:
            n = order[n]
            return joined[start[n] : end[n]] if n < len(start) else flat[n - len(start)]

        first_hashes, first_checks = self._hashed(laid.codes, start, end)
        owner = np.concatenate((place, owner))
        order = np.argsort(owner, kind="stable")
        hashes = np.concatenate((first_hashes, hashes))[order]
        checks = np.concatenate((first_checks, checks))[order]
        return Words(hashes, checks, np.bincount(owner, minlength=len(texts)), word)

    def _hashed(self, codes, start, end) -> tuple[np.ndarray, np.ndarray]:
        hashes, checks = span_hashes(codes, start, end)
        return hashes & self.mask, checks

    def _listed(self, text: str) -> list[str]:
        words = []
        for n, part in enumerate(self.pattern.split(text) if self.pattern else (text,)):
            if n % 2:
                words.append(part)
            elif part:
                if self.whole.normalizer is not None:
                    part = self.whole.normalizer.normalize_str(part)
                divided = self.divide.pre_tokenize_str(part) if self.divide else [(part, None)]
                words += [word for word, _ in divided]
        return words

    def encode(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        if self.shown is not None and not (word.isascii() and word.isprintable()):
            word = "".join(map(self.shown.__getitem__, word.encode()))
        return [token.id for token in self.whole.model.tokenize(word)]


def distinct_words(
    df: DataFrame, text: str = "text", vocabulary: str | None = None, bits: int = 64
) -> DataFrame:
    """``word``, its ``hash``, how often it stands in all texts (``n``) and its ``ids``.

    Tasks count their own words and hand on each of them once (some more often, if they
    meet very many); every distinct word is then encoded once.
    """
    path = vocabulary or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path, bits).split
        held = _Counts()
        for batch in batches:
            for start, length in slices(batch.column(0)):
                texts = [t or "" for t in batch.column(0).slice(start, length).to_pylist()]
                for part in chunks(texts):
                    held.add(split(texts[part]))
                    if len(held.words) > HELD_WORDS:
                        yield from held.batches()
                        held = _Counts()
        yield from held.batches()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(path, bits).encode
        for batch in batches:
            ids = [own(word) for word in batch.column("word").to_pylist()]
            columns = [batch.column(n) for n in ("hash", "word", "n")]
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["hash", "word", "n", "ids"])

    schema = "hash bigint, word string, n bigint"
    counted = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, schema)
    words = counted.groupBy("hash", "word").agg(F.sum("n").alias("n"))
    return words.mapInArrow(encode, f"{schema}, ids array<int>")


class _Counts:
    """Distinct words of a task, by hash, and how often each was met."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.checks = np.zeros(0, np.uint64)
        self.words: list[str] = []
        # Words whose hash another word has.
        self.shared: Counter[tuple[int, str]] = Counter()

    def add(self, found: Words) -> None:
        hashes, first, inverse, counts = np.unique(
            found.hashes, return_index=True, return_inverse=True, return_counts=True
        )
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        checks = found.checks[first]
        checks[known] = self.checks[self.places[at[known]]]
        other = np.flatnonzero(found.checks != checks[inverse])
        for n in other.tolist():
            self.shared[int(found.hashes[n]), found.word(n)] += 1
        np.subtract.at(counts, inverse[other], 1)
        self.counts[self.places[at[known]]] += counts[known]
        new = first[~known]
        if not len(new):
            return
        places = len(self.words) + np.arange(len(new))
        self.words += [found.word(n) for n in new.tolist()]
        self.counts = np.concatenate((self.counts, counts[~known]))
        self.checks = np.concatenate((self.checks, checks[~known]))
        merged = np.concatenate((self.hashes, hashes[~known]))
        order = np.argsort(merged)
        self.hashes = merged[order]
        self.places = np.concatenate((self.places, places))[order]

    def batches(self, size: int = 20_000) -> Iterator[pa.RecordBatch]:
        hashes = np.empty(len(self.words), np.uint64)
        hashes[self.places] = self.hashes
        more = list(self.shared)
        hashes = np.concatenate((hashes, np.array([h for h, _ in more], np.uint64)))
        words = self.words + [word for _, word in more]
        counts = np.concatenate((self.counts, np.array([self.shared[k] for k in more], np.int64)))
        for n in range(0, len(words), size):
            columns = [
                pa.array(hashes[n : n + size].view(np.int64)),
                pa.array(words[n : n + size], pa.string()),
                pa.array(counts[n : n + size]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["hash", "word", "n"])


class Table:
    """Hashes of words, sorted, and the ids of each."""

    def __init__(self, hashes: np.ndarray, lists: pa.ListArray):
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(hashes)
        self.hashes, self.sizes = hashes[order], sizes[order]
        self.places = (np.cumsum(sizes) - sizes)[order]
        self.ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)

    @classmethod
    def of(cls, rows: pa.Table) -> "Table":
        lists = rows.column("ids").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        return cls(rows.column("hash").to_numpy().view(np.uint64), lists)

    def joined(self, other: "Table") -> "Table":
        both = Table.__new__(Table)
        hashes = np.concatenate((self.hashes, other.hashes))
        order = np.argsort(hashes)
        both.hashes = hashes[order]
        both.sizes = np.concatenate((self.sizes, other.sizes))[order]
        both.places = np.concatenate((self.places, other.places + len(self.ids)))[order]
        both.ids = np.concatenate((self.ids, other.ids))
        return both

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table, and whether the word is there at all."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


def encode(
    df: DataFrame,
    text: str = "text",
    ids: str = "ids",
    keep: list[str] | None = None,
    vocabulary: str | None = None,
    head_words: int = HEAD_WORDS,
    bits: int = 64,
) -> DataFrame:
    """Columns ``keep`` of ``df`` (all by default) and the ids of its texts, as
    ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    The table of distinct words is staged. ``bits`` is the width of the hashes.
    """
    spark = df.sparkSession
    path = vocabulary or vocabulary_path()
    words = stage(distinct_words(df, text, path, bits), "words")
    shared = words.groupBy("hash").count().where("count > 1").select("hash")
    shared = shared.limit(SHARED_HASHES + 1).toArrow().column("hash").to_numpy()
    if len(shared) > SHARED_HASHES:
        raise RuntimeError("too many words share a hash")
    # By powers of two of their number, so that no table of words is sorted for its head.
    level = F.floor(F.log2("n")).cast("int").alias("level")
    least, held = 64, 0
    levels = words.groupBy(level).agg(F.count("*").alias("size")).orderBy(F.desc("level")).collect()
    for row in levels:
        held += row["size"]
        if held > head_words:
            break
        least = row["level"]
    head = Table.of(words.where(level >= least).select("hash", "ids").toArrow())
    head = spark.sparkContext.broadcast((head, np.sort(shared.view(np.uint64))))
    answers = None
    if held > head_words:
        answers = fresh_path(spark, "answers")
        asked = _asked(df, text, path, bits, head)
        rest = words.where(level < least).select("hash", F.col("ids").alias("own"))
        answered = asked.join(rest, "hash").select("part", "hash", F.col("own").alias("ids"))
        answered.repartition("part").write.partitionBy("part").parquet(answers)
    keep = df.columns if keep is None else keep
    return _looked_up(df, text, ids, keep, path, bits, head, answers)


def _asked(df: DataFrame, text: str, path: str, bits: int, head) -> DataFrame:
    """Hashes of the words of each partition that are not broadcast, once each (more often
    where there are very many)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (table, _) = splitter(path, bits), head.value
        part, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            if batch.num_rows:
                part = batch.column(1)[0].as_py()
            for start, length in slices(batch.column(0)):
                texts = [t or "" for t in batch.column(0).slice(start, length).to_pylist()]
                for some in chunks(texts):
                    hashes = np.unique(own.split(texts[some]).hashes)
                    held = np.union1d(held, hashes[~table.find(hashes)[1]])
                    if len(held) > HELD_WORDS:
                        yield rows(part, held)
                        held = held[:0]
        if len(held):
            yield rows(part, held)

    def rows(part, hashes):
        columns = [pa.array(np.full(len(hashes), part, np.int32)), pa.array(hashes.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["part", "hash"])

    return _parts(df, [], text).mapInArrow(ask, "part int, hash bigint")


def _parts(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in keep]
    return df.select(*columns, F.col(f"`{text}`").alias("_text"), F.spark_partition_id().alias("_part"))


def _answers(folder: str, part: int) -> Table:
    files, base = open_files(folder)
    found = files.get_file_info(pafs.FileSelector(f"{base}/part={part}", allow_not_found=True))
    paths = [i.path for i in found if i.base_name.endswith(".parquet")]
    tables = [pq.read_table(p, filesystem=files, partitioning=None, columns=["hash", "ids"]) for p in paths]
    kind = pa.schema([("hash", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return Table.of(pa.concat_tables([t.cast(kind) for t in tables] or [kind.empty_table()]))


def _looked_up(df, text, ids, keep, path, bits, head, answers) -> DataFrame:
    out = T.StructType([*(df.schema[c] for c in keep), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(out)
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (table, shared) = splitter(path, bits), head.value
        loaded = None
        for batch in batches:
            if answers is not None and batch.num_rows and loaded != (part := batch.column(width + 1)[0].as_py()):
                table, loaded = head.value[0].joined(_answers(answers, part)), part
            for start, length in slices(batch.column(width)):
                some = batch.slice(start, length)
                texts = [t or "" for t in some.column(width).to_pylist()]
                for part in chunks(texts):
                    rows = some.slice(part.start, part.stop - part.start)
                    arrays = [rows.column(n).cast(arrow.field(n).type) for n in range(width)]
                    arrays.append(_ids(own, table, shared, texts[part]).cast(arrow.field(width).type))
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return _parts(df, keep, text).mapInArrow(run, out)


def _ids(own: Splitter, table: Table, shared: np.ndarray, texts: list[str]) -> pa.ListArray:
    found = own.split(texts)
    owner = np.repeat(np.arange(len(texts)), found.sizes)
    at, known = table.find(found.hashes)
    doubtful = np.unique(owner[np.isin(found.hashes, shared)]) if len(shared) else owner[:0]
    missing = ~known
    missing[np.isin(owner, doubtful)] = False
    if missing.any():
        hashes, first = np.unique(found.hashes[missing], return_index=True)
        words = [own.encode(found.word(n)) for n in np.flatnonzero(missing)[first].tolist()]
        table = table.joined(Table(hashes, pa.array(words, pa.list_(pa.int32()))))
        at, known = table.find(found.hashes)
    sizes, places = (np.where(known, v[at], 0) if len(v) else at for v in (table.sizes, table.places))
    values = table.ids[expand(places, sizes)]
    lengths = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)
    if len(doubtful):
        parts = np.split(values, np.cumsum(lengths)[:-1])
        for n in doubtful.tolist():
            encoded = own.whole.encode(texts[n], add_special_tokens=False).ids
            parts[n] = np.array(encoded, np.int32)
            lengths[n] = len(encoded)
        values = np.concatenate(parts)
    return pa.ListArray.from_arrays(pa.array(sizes_to_offsets(lengths), pa.int32()), pa.array(values))


def pieces_table(spark: SparkSession, vocabulary: str | None = None) -> DataFrame:
    """``id`` and ``piece`` of a whole vocabulary."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary or vocabulary_path()).get_vocab(with_added_tokens=True)
    return spark.createDataFrame(pa.table({"id": list(found.values()), "piece": list(found)}))


def decode(
    df: DataFrame, ids: str = "ids", decoded: str = "decoded", vocabulary: str | None = None
) -> DataFrame:
    """``df`` and the text of its ids, as ``Tokenizer.decode(ids, skip_special_tokens=False)``
    gives it: each id is looked up among the pieces, and those are joined.

    A vocabulary has a bounded number of pieces, so they are broadcast. Null ids give null.
    """
    from tokenizers import Tokenizer

    path = vocabulary or vocabulary_path()
    found = pieces_table(df.sparkSession, path).toArrow().to_pydict()
    pieces = np.full(max(found["id"], default=-1) + 1, None, object)
    pieces[found["id"]] = found["piece"]
    shared = df.sparkSession.sparkContext.broadcast(pa.array(pieces, pa.string()))
    joined = Tokenizer.from_file(path).decoder is None
    out = T.StructType([f for f in df.schema if f.name != decoded] + [T.StructField(decoded, T.StringType())])
    arrow = to_arrow_schema(out)
    width = len(out) - 1
    columns = [F.col(f"`{f.name}`") for f in out.fields[:width]]
    # The ids go to Python once, with the columns that are kept.
    place = next((n for n, f in enumerate(out.fields[:width]) if f.name == ids), width)
    if place == width:
        columns.append(F.col(f"`{ids}`").alias("_ids"))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_pylist()
            start, held = 0, 0
            for n, size in enumerate(sizes):
                if n > start and held + size > DECODED_IDS:
                    yield batch.slice(start, n - start)
                    start, held = n, 0
                held += size
            if start < len(sizes):
                yield batch.slice(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        decoder = None if joined else kept_in_process(f"decoder {path}", lambda: Tokenizer.from_file(path)).decoder
        for batch in sliced(batches):
            column = batch.column(place)
            texts = pieces.take(pc.list_flatten(column))
            if texts.null_count:
                raise ValueError("an id is not in the vocabulary")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            offsets = sizes_to_offsets(sizes)
            if decoder is None:
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts)
                made = pc.binary_join(lists, " ")
            else:
                spans = zip(offsets[:-1].tolist(), offsets[1:].tolist())
                made = pa.array([decoder.decode(texts[s:e].to_pylist()) for s, e in spans], pa.string())
            made = pc.if_else(column.is_null(), None, made)
            arrays = [batch.column(n).cast(arrow.field(n).type) for n in range(width)]
            yield pa.RecordBatch.from_arrays([*arrays, made.cast(arrow.field(width).type)], schema=arrow)

    return df.select(*columns).mapInArrow(run, out)
