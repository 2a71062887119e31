"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages of PASSAGE_WORDS words. Over the words and word pairs of
the benchmark, each passage is a TF-IDF vector; document frequencies are counted over
all passages. A randomised SVD gives the latent space: every task multiplies its
passages' Gram matrix with one random matrix, the products are summed over the cluster,
and the singular vectors follow from the sum (Nystroem form, one pass over the texts).
The benchmark's own passages weigh as much in it as the corpus, so that rare items keep
their directions. Pairs of neighbouring passages whose latent vector has a cosine of
``cosine`` or more with an item are candidates; around them the longest common
subsequence of words decides: a share of ``copied`` of the item is a leak, a share of
``paraphrased`` is one if the item's answer (its last sentence, five words at least) is
there as well.

The benchmark is worked through in blocks of ITEMS items, each with a scan of its own,
so that what is broadcast (terms, latent vectors) is bounded; the texts are never
shuffled, and the sums have one row per task and slice of the terms.

Words are runs of letters and digits in lower case. Null and empty texts hold no leak;
null or repeated item ids are items like others; items of fewer than MIN_ITEM_WORDS
words are never found. Repeated rows are judged alike. Other columns are not read by
``find_leaks`` and are kept by ``drop_leaks``. An empty benchmark finds nothing.
"""

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawltable.llm.arrow import slices
from crawltable.llm.chars import RollingHash, Texts, chunks, kept_in_process, mixed
from crawltable.llm.letters import letter_table, lower_table
from crawltable.llm.tokens import NUMBER, character_classes

PASSAGE_WORDS = 32
RANK = 96
ITEMS = 400
MIN_ITEM_WORDS = 5
MIN_ANSWER_WORDS = 5
COSINE = 0.3
# Sums of tasks added up at a time, and rounds of that.
FAN_IN, ROUNDS = 32, 4
COPIED = 0.8
PARAPHRASED = 0.6
ANSWERED = 0.8
# Words of a text compared with an item, as a multiple of the item's words.
REACH = 1.3

# Code points looked at together; latent vectors of their words are held meanwhile.
CHUNK = 1 << 18
# Bits of a set of words, and passages to either side that are looked through by them.
BITS = 2048
MAX_AROUND = 16
# Terms per row of the sums.
SLICE = 4096


def word_table() -> np.ndarray:
    return kept_in_process("word_table", lambda: letter_table() | (character_classes() == NUMBER))


@dataclass(frozen=True)
class Terms:
    """Sorted hashes of the benchmark's words and word pairs, and their weights."""

    hashes: np.ndarray
    weights: np.ndarray

    def filter(self) -> np.ndarray:
        wanted = np.zeros(1 << 20, bool)
        wanted[self.hashes >> np.uint64(44)] = True
        return wanted


class Passages:
    """Words of texts and the terms they hold, by passage."""

    def __init__(self, texts: Sequence[str]):
        laid = self.laid = Texts(texts)
        inside = word_table()[laid.codes]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
        self.start, self.end = edges[::2], edges[1::2]
        self.words = RollingHash(lower_table()[laid.codes]).spans(self.start, self.end)
        self.owner = laid.owner(self.start)
        first = np.searchsorted(self.owner, np.arange(len(texts)))
        within = np.arange(len(self.start)) - first[self.owner]
        new = within % PASSAGE_WORDS == 0
        self.passage = np.cumsum(new) - 1
        self.passage_start = np.flatnonzero(new)
        self.passage_owner = self.owner[self.passage_start]

    def __len__(self) -> int:
        return len(self.passage_start)

    def terms(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Hash and passage of each word and of each pair of neighbouring words."""
        yield self.words, self.passage
        pair = self.owner[1:] == self.owner[:-1]
        hashes = mixed(self.words[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.words[1:])
        yield hashes[pair], self.passage[:-1][pair]

    def known(self, terms: Terms, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``terms`` and passages of the terms that are there."""
        places, passages = [], []
        for hashes, passage in self.terms():
            hits = np.flatnonzero(wanted[hashes >> np.uint64(44)])
            place = np.searchsorted(terms.hashes, hashes[hits])
            place[place == len(terms.hashes)] = 0
            same = terms.hashes[place] == hashes[hits]
            places.append(place[same])
            passages.append(passage[hits[same]])
        return np.concatenate(places), np.concatenate(passages)


def _scan(df: DataFrame, text: str, make: Callable, schema: str) -> DataFrame:
    """Run ``add`` on the passages of all texts and then yield ``result``'s rows, per task."""
    source = df.select(F.col(f"`{text}`")).where(F.col(f"`{text}`").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, result = make()
        for batch in batches:
            for start, length in slices(batch.column(0)):
                texts = batch.column(0).slice(start, length).to_pylist()
                for part in chunks(texts, CHUNK):
                    add(Passages(texts[part]))
        yield from result()

    return source.mapInArrow(run, schema)


def _frequencies(df: DataFrame, text: str, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and all passages."""
    shared = df.sparkSession.sparkContext.broadcast(hashes)

    def make():
        terms = Terms(shared.value, np.zeros(0))
        wanted, counts, total = terms.filter(), np.zeros(len(terms.hashes), np.int64), [0]

        def add(found: Passages):
            place, passage = found.known(terms, wanted)
            pairs = np.unique(place * np.int64(max(1, len(found))) + passage)
            counts[:] += np.bincount(pairs // max(1, len(found)), minlength=len(counts))
            total[0] += len(found)

        def result():
            used = np.flatnonzero(counts)
            place = np.append(used, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(np.append(counts[used], total[0]))], names=["place", "n"]
            )

        return add, result

    found = _scan(df, text, make, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    rows = found.toArrow()  # one row per term of the block
    place, n = (rows.column(k).to_numpy() for k in (0, 1))
    counts = np.zeros(len(hashes), np.int64)
    counts[place[place >= 0]] = n[place >= 0]
    return counts, int(n[place < 0].sum())


def random_matrix(n: int, rank: int, seed: int = 10) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((n, rank), dtype=np.float32)


def _weighted(found: Passages, terms: Terms, wanted: np.ndarray):
    """Places, passages and TF-IDF weights of the terms that weigh anything."""
    place, passage = found.known(terms, wanted)
    heavy = terms.weights[place] > 0
    return place[heavy], passage[heavy], terms.weights[place[heavy]]


def _combined(rows: np.ndarray, at: np.ndarray, weight: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Weighted sums of ``rows[at]`` for each group of entries that begins at ``heads``.

    Groups of about equal size are padded to a width and multiplied together."""
    sizes = np.diff(np.append(heads, len(at)))
    out = np.empty((len(heads), rows.shape[1]), np.float32)
    step = np.int64(1) << np.maximum(np.frexp(sizes)[1].astype(np.int64) - 4, 0)
    widths = -(-sizes // step) * step
    order = np.argsort(widths, kind="stable")
    bounds = np.flatnonzero(np.diff(widths[order], prepend=-1))
    for first, last in zip(bounds.tolist(), np.append(bounds[1:], len(order)).tolist()):
        width = int(widths[order[first]])
        places = np.arange(width)
        for k in range(first, last, max(1, CHUNK // 8 // width)):
            some = order[k : min(last, k + max(1, CHUNK // 8 // width))]
            inside = places < sizes[some, None]
            entry = np.where(inside, heads[some, None] + places, 0)
            factor = np.where(inside, weight[entry], np.float32(0))
            out[some] = np.matmul(factor[:, None, :], rows[at[entry]])[:, 0]
    return out


def _project(place, passage, weight, matrix: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(passage, kind="stable")
    passage = passage[order]
    heads = np.flatnonzero(np.diff(passage, prepend=-1))
    out = np.zeros((n, matrix.shape[1]), np.float32)
    out[passage[heads]] = _combined(matrix, place[order], weight[order], heads)
    return out


def gram_product(place, passage, weight, matrix: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and their rows of A'(A matrix), A having the passages as rows."""
    latent = _project(place, passage, weight, matrix, n)
    order = np.argsort(place, kind="stable")
    place = place[order]
    heads = np.flatnonzero(np.diff(place, prepend=-1))
    return place[heads], _combined(latent, passage[order], weight[order], heads)


def _sketch(df: DataFrame, text: str, terms: Terms, rank: int) -> tuple[np.ndarray, float]:
    """A'(A random) over all passages, and the sum of squares of A."""
    shared = df.sparkSession.sparkContext.broadcast((terms.hashes, terms.weights))

    def make():
        own = Terms(*shared.value)
        wanted, random = own.filter(), random_matrix(len(own.hashes), rank)
        total, squares = np.zeros((len(own.hashes), rank), np.float32), [0.0]

        def add(found: Passages):
            place, passage, weight = _weighted(found, own, wanted)
            at, rows = gram_product(place, passage, weight, random, len(found))
            total[at] += rows
            squares[0] += float((weight.astype(np.float64) ** 2).sum())

        def result():
            for first in range(0, len(total), SLICE):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([first], pa.int64()),
                        pa.array([total[first : first + SLICE].tobytes()]),
                        pa.array([squares[0] if first == 0 else 0.0]),
                    ],
                    names=["first", "rows", "squares"],
                )

        return add, result

    parts = _scan(df, text, make, "first bigint, rows binary, squares double")
    # Every round adds up to FAN_IN sums at a time, so a task's share does not grow with the
    # number of tasks; the rounds suffice for a million of them.
    parts = parts.select("first", "rows", "squares", F.spark_partition_id().alias("step"))
    for _ in range(ROUNDS):
        parts = parts.withColumn("step", F.floor(F.col("step") / FAN_IN).cast("int"))
        parts = parts.groupBy("first", "step").applyInArrow(
            _added, "first bigint, rows binary, squares double, step int"
        )
    summed = parts.toArrow().sort_by("first")  # terms x rank numbers
    blocks = [np.frombuffer(b, np.float32).reshape(-1, rank) for b in summed.column("rows").to_pylist()]
    return np.concatenate(blocks), float(sum(summed.column("squares").to_pylist()))


def _added(rows: pa.Table) -> pa.Table:
    total, squares = None, 0.0
    for n in range(rows.num_rows):
        own = np.frombuffer(rows.column("rows")[n].as_buffer(), np.float32).astype(np.float64)
        total = own if total is None else total + own
        squares += rows.column("squares")[n].as_py()
    return pa.table(
        {
            "first": pa.array([rows.column("first")[0].as_py()], pa.int64()),
            "rows": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
            "squares": pa.array([squares], pa.float64()),
            "step": rows.column("step").slice(0, 1).cast(pa.int32()),
        }
    )


def singular_vectors(sketch: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Right singular vectors of A from A'A random: of the Nystroem form of A'A."""
    sketch, random = sketch.astype(np.float64), random.astype(np.float64)
    shift = 1e-7 * np.linalg.norm(sketch) + 1e-12
    shifted = sketch + shift * random
    core = random.T @ shifted
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    values = np.maximum(values, values.max() * 1e-10)
    half = shifted @ (vectors / np.sqrt(values))
    left, _, _ = np.linalg.svd(half, full_matrices=False)
    return left.astype(np.float32)


@dataclass(frozen=True)
class Index:
    """What a scan needs of one block of the benchmark."""

    hashes: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray  # terms x rank
    latent: np.ndarray  # item passages x rank, of unit length
    owners: np.ndarray  # item of each item passage
    items: list[tuple]
    limits: tuple


def build_index(
    df: DataFrame, texts: list[str], text: str = "text", rank: int = RANK,
    cosine: float = COSINE, copied: float = COPIED, paraphrased: float = PARAPHRASED,
) -> Index | None:
    """Index of the items ``texts``, its statistics taken from all texts of ``df``; None
    where there is no item or no text with a word."""
    items, pieces, owners = [], [], []
    found = Passages(texts)
    for n in range(len(texts)):
        span = np.flatnonzero(found.owner == n)
        if len(span) < MIN_ITEM_WORDS:
            continue
        words = found.words[span].tolist()
        items.append((n, words, _answer(texts[n], found, span)))
        for first in range(0, len(span), 2 * PASSAGE_WORDS):
            part = span[first : first + 2 * PASSAGE_WORDS]
            s, e = found.start[part[0]], found.end[part[-1]]
            pieces.append("".join(map(chr, found.laid.codes[s:e].tolist())))
            owners.append(len(items) - 1)
    if not items:
        return None
    own = Passages(pieces)
    hashes = np.unique(np.concatenate([h for h, _ in own.terms()]))
    counts, total = _frequencies(df, text, hashes)
    if not total:
        return None
    # Terms in more than half of the passages weigh nothing.
    weights = np.log((total + 1) / (2.0 * (counts + 0.5)))
    terms = Terms(hashes, np.maximum(weights, 0).astype(np.float32))
    rank = min(rank, len(hashes))
    sketch, squares = _sketch(df, text, terms, rank)
    random = random_matrix(len(hashes), rank)
    place, passage, weight = _weighted(own, terms, terms.filter())
    piece = own.passage_owner[passage]
    at, rows = gram_product(place, piece, weight, random, len(pieces))
    share = squares / max(float((weight.astype(np.float64) ** 2).sum()), 1e-12)
    sketch[at] += rows * np.float32(max(share, 1.0))
    vectors = singular_vectors(sketch, random)
    latent = _project(place, piece, weight, vectors, len(pieces))
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return Index(
        terms.hashes, terms.weights, vectors, latent, np.array(owners), items,
        (cosine, copied, paraphrased),
    )


def _answer(text: str, found: Passages, span: np.ndarray) -> list[int]:
    """Words of the last sentence, or the last few where that is shorter."""
    ends = found.laid.starts[found.owner[span[0]]]
    last = len(span) - MIN_ANSWER_WORDS
    for n in range(len(span) - 1, 0, -1):
        between = text[found.end[span[n - 1]] - ends : found.start[span[n]] - ends]
        if any(c in between for c in ".!?\n"):
            last = min(last, n)
            break
    return found.words[span[max(last, 0) :]].tolist()


def common_words(item: Sequence[int], words: Sequence[int]) -> int:
    """Length of the longest common subsequence, 1 bit of a number per word of the item."""
    return _common(word_masks(item), len(item), words)


def word_masks(item: Sequence[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for n, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << n
    return masks


def _common(masks: dict[int, int], n: int, words: Sequence[int]) -> int:
    full = (1 << n) - 1
    left = full
    for word in words:
        mask = masks.get(word)
        if mask is not None:
            hit = left & mask
            left = ((left + hit) | (left - hit)) & full
    return n - left.bit_count()


def _bits(words: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` rows the set of its words, a bit of BITS each."""
    bits = np.zeros((n, BITS // 64), np.uint64)
    place = (words >> np.uint64(32)) % np.uint64(BITS)
    cells = np.sort(rows * np.int64(BITS) + place.astype(np.int64))
    word, bit = cells // 64, np.uint64(1) << (cells % 64).astype(np.uint64)
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    if len(heads):
        bits.reshape(-1)[word[heads]] = np.bitwise_or.reduceat(bit, heads)
    return bits


class Searcher:
    """Finds the items of an index in texts."""

    def __init__(self, index: Index):
        self.index = index
        self.terms = Terms(index.hashes, index.weights)
        self.wanted = self.terms.filter()
        self.masks = [
            [(word_masks(part), len(part)) for part in (words, answer)]
            for _, words, answer in index.items
        ]
        self.often = [Counter(words) for _, words, _ in index.items]
        self.sizes = np.array([len(words) for _, words, _ in index.items], np.int64)
        owners = np.repeat(np.arange(len(index.items)), self.sizes)
        words = np.array([w for _, words, _ in index.items for w in words], np.uint64)
        self.bits = _bits(words, owners, len(index.items))
        self.distinct = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.counted = [
            np.unique(np.array(words, np.uint64), return_counts=True) for _, words, _ in index.items
        ]

    def search(self, texts: Sequence[str]) -> list[tuple]:
        """text number, item number, cosine, common words, words of the item, and place
        (code points) of each leak, the best of each item and text."""
        out = []
        for part in chunks(texts, CHUNK):
            out += [(part.start + hit[0], *hit[1:]) for hit in self._search(texts[part])]
        return out

    def _search(self, texts):
        found = Passages(texts)
        if not len(found):
            return []
        cosine, copied, paraphrased = self.index.limits
        place, passage, weight = _weighted(found, self.terms, self.wanted)
        latent = _project(place, passage, weight, self.index.vectors, len(found))
        joined = np.append(found.passage_owner[1:] == found.passage_owner[:-1], False)
        latent[joined] += latent[np.flatnonzero(joined) + 1]
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        scores = latent @ self.index.latent.T
        window, piece = np.nonzero(scores >= cosine)
        able = self._may_hold(found, window, self.index.owners[piece], paraphrased)
        window, piece = window[able], piece[able]
        best: dict[tuple, tuple] = {}
        owner = found.passage_owner[window]
        item = self.index.owners[piece]
        ends = np.searchsorted(found.owner, np.arange(len(texts) + 1))
        for w, o, i, score in zip(window.tolist(), owner.tolist(), item.tolist(), scores[window, piece].tolist()):
            hit = self._check(found, i, int(found.passage_start[w]), int(ends[o]), int(ends[o + 1]), copied, paraphrased)
            if hit and hit[0] > best.get((o, i), (0,))[0]:
                common, first, last = hit
                place = found.laid.starts[o]
                best[o, i] = (
                    common, score, len(self.index.items[i][1]),
                    int(found.start[first] - place), int(found.end[last - 1] - place),
                )
        return [
            (o, self.index.items[i][0], score, common, n, start, end)
            for (o, i), (common, score, n, start, end) in best.items()
        ]

    def _may_hold(self, found, window, item, share) -> np.ndarray:
        """Whether the passages around a window may hold that share of an item's words, told
        by bits of the words: words with one bit count as there if one of them is."""
        able = np.ones(len(window), bool)
        bits = _bits(found.words, found.passage, len(found))
        first = np.searchsorted(found.passage_owner, found.passage_owner)
        last = np.searchsorted(found.passage_owner, found.passage_owner, "right") - 1
        around = -(-self.sizes // PASSAGE_WORDS)[item]
        for reach in np.unique(around[around <= MAX_AROUND]).tolist():
            some = np.flatnonzero(around == reach)
            places, back = np.unique(window[some], return_inverse=True)
            region = bits[places]
            for step in range(-reach, reach + 2):
                region |= bits[np.clip(places + step, first[places], last[places])]
            there = np.bitwise_count(region[back] & self.bits[item[some]]).sum(axis=1, dtype=np.int64)
            there += self.sizes[item[some]] - self.distinct[item[some]]
            able[some] = there >= share * self.sizes[item[some]]
        return able

    def _check(self, found, item, window, low, high, copied, paraphrased):
        (masks, n), (answer, n_answer) = self.masks[item]
        reach = int(np.ceil(REACH * n))
        first = max(low, window - n)
        last = min(high, window + 2 * PASSAGE_WORDS + n)
        # A window cannot have more words in common than it has words of the item, each as
        # often as the item at most: only windows that may reach the limit are compared.
        needed = paraphrased * n
        words = found.words[first:last]
        present = self.often[item].keys() & words.tolist()
        if sum(map(self.often[item].__getitem__, present)) < needed:
            return None  # nor has any window in it
        known, counts = self.counted[item]
        place = np.searchsorted(known, words)
        place[place == len(known)] = 0
        hit = known[place] == words
        sums = np.concatenate(([0], np.cumsum(hit)))
        starts = np.arange(0, max(1, len(words) - reach + 1 + n // 4), max(1, n // 8))
        ends = np.minimum(starts + reach, len(words))
        best = (0, first, first)
        for k in np.flatnonzero(sums[ends] - sums[starts] >= needed).tolist():
            start, end = int(starts[k]), int(ends[k])
            inside = place[start:end][hit[start:end]]
            if np.minimum(np.bincount(inside, minlength=len(counts)), counts).sum() < needed:
                continue
            common = _common(masks, n, words[start:end].tolist())
            if common > best[0]:
                best = (common, first + start, first + end)
        common, start, end = best
        if common >= copied * n:
            return best
        if common >= paraphrased * n:
            part = found.words[start:end].tolist()
            if _common(answer, n_answer, part) >= ANSWERED * n_answer:
                return best
        return None


def blocks(benchmark: DataFrame, id: str, text: str) -> Iterator[list[tuple]]:
    """Ids and texts of ITEMS items at a time."""
    rows = benchmark.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.where("text IS NOT NULL")
    n = rows.count()
    if n <= ITEMS:
        held = [tuple(r) for r in rows.orderBy("id", "text").collect()]
        if held:
            yield held
        return
    part = F.pmod(F.xxhash64("id", "text"), F.lit(-(-2 * n // ITEMS)))
    for k in range(-(-2 * n // ITEMS)):
        held = [tuple(r) for r in rows.where(part == k).orderBy("id", "text").collect()]
        for first in range(0, len(held), ITEMS):
            yield held[first : first + ITEMS]


LEAKS = """doc_id bigint, item_id bigint, cosine double, common_words bigint, item_words bigint,
  start bigint, `end` bigint"""


def find_leaks(
    df: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", **limits,
) -> DataFrame:
    """One row per document and item found in it."""
    spark = df.sparkSession
    result = spark.createDataFrame([], LEAKS)
    source = df.select(F.col(f"`{id}`").cast("bigint"), F.col(f"`{text}`").alias("text"))
    for held in blocks(benchmark, item_id, item_text):
        index = build_index(df, [t for _, t in held], text, **limits)
        if index is None:
            continue
        shared = spark.sparkContext.broadcast((tuple(vars(index).values()), [i for i, _ in held]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            parts, ids = shared.value
            searcher = Searcher(Index(*parts))
            kinds = (pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4)
            for batch in batches:
                for start, length in slices(batch.column(1)):
                    some = batch.slice(start, length)
                    docs = some.column(0).to_pylist()
                    hits = searcher.search([t or "" for t in some.column(1).to_pylist()])
                    rows = [(docs[n], ids[i], *rest) for n, i, *rest in hits]
                    columns = zip(*rows) if rows else [[]] * 7
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["doc_id", "item_id", "cosine", "common_words", "item_words", "start", "end"],
                    )

        result = result.unionByName(source.mapInArrow(run, LEAKS))
    return result


def drop_leaks(
    df: DataFrame, benchmark: DataFrame, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", **limits,
) -> DataFrame:
    """The rows of ``df`` in whose text no item is found, all columns as they were."""
    spark = df.sparkSession
    result, place = df, df.columns.index(text)
    for held in blocks(benchmark, item_id, item_text):
        index = build_index(df, [t for _, t in held], text, **limits)
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(tuple(vars(index).values()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(Index(*shared.value))
            for batch in batches:
                for start, length in slices(batch.column(place)):
                    some = batch.slice(start, length)
                    texts = [t or "" for t in some.column(place).to_pylist()]
                    kept = np.ones(len(texts), bool)
                    kept[[hit[0] for hit in searcher.search(texts)]] = False
                    yield some.filter(pa.array(kept))

        result = result.mapInArrow(run, df.schema)
    return result
