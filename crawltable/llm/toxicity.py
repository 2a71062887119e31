"""Toxicity by multiple-instance learning.

Only documents have labels. A sentence scores s = sigmoid(b + sum of the weights of its
features) and a document 1 - product of (1 - s), the noisy-or of its sentences; weights
are trained from the document labels through that, with an L1 penalty. Afterwards the
sentence scores locate what offends.

Features are words of letters in lower case, their prefixes and suffixes, told by 64-bit
hashes. The model is fitted on a sample of at most about SAMPLE_POSITIVE and
SAMPLE_NEGATIVE labelled documents, chosen by a hash of their ids: counts per feature
select what differs between the classes, and only these features of the sample reach the
driver. Every whole text is scored.

Null and empty texts have no sentence and score 0. Rows with a null id or label are not
learned from; a null id counts as held out; of several labels of an id the highest
counts. Without both classes all scores are 0. Repeated rows keep a row each. Other
columns are not read.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawltable.llm.arrow import map_texts, slices
from crawltable.llm.chars import RollingHash, Texts, chunks
from crawltable.llm.letters import letter_table, lower_table
from crawltable.workspace import scratch, stage

SAMPLE_POSITIVE = 1_500
SAMPLE_NEGATIVE = 4_500
PREFIXES = (4, 5, 6)
SUFFIXES = (4, 5)
MIN_DOCUMENTS = 3
MIN_Z = 4.0
THRESHOLD = 0.7
SENTENCE_THRESHOLD = 0.5
ENDS = ".!?\n"

STEPS = 400
RATE = 0.1
PENALTY = 2e-4


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        wanted = np.zeros(1 << 20, bool)
        wanted[self.features >> np.uint64(44)] = True
        object.__setattr__(self, "wanted", wanted)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` the model knows, and their places in ``features``."""
        hits = np.flatnonzero(self.wanted[hashes >> np.uint64(44)])
        place = np.searchsorted(self.features, hashes[hits])
        place[place == len(self.features)] = 0
        known = self.features[place] == hashes[hits] if len(self.features) else place < 0
        return hits[known], place[known]


def sentence_features(laid: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, Iterator]:
    """Text and first place of each sentence with a word, and pairs of feature hashes
    and their sentences."""
    letters = letter_table()[laid.codes]
    rolling = RollingHash(lower_table()[laid.codes])
    edges = np.flatnonzero(np.diff(np.concatenate(([False], letters, [False]))))
    start, end = edges[::2], edges[1::2]
    stops = np.cumsum(np.isin(laid.codes, [ord(c) for c in ENDS]))
    stop = stops[start] if len(start) else start
    new = np.diff(stop, prepend=-1) != 0  # a text ends in a newline, so sentences do too
    sentence = np.cumsum(new) - 1
    owner = laid.owner(start[new])

    def features():
        yield rolling.spans(start, end), sentence
        for kind, lengths in ((1, PREFIXES), (2, SUFFIXES)):
            for n in lengths:
                long = np.flatnonzero(end - start >= n)
                s, e = (start[long], start[long] + n) if kind == 1 else (end[long] - n, end[long])
                salt = np.uint64(0x9E3779B97F4A7C15 * (2 * n + kind) & (1 << 64) - 1)
                yield rolling.spans(s, e) ^ salt, sentence[long]

    return owner, start[new], end, features()


def learn(
    documents: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model | None:
    """Fit on the documents that ``labels`` names, of which at most SAMPLE_POSITIVE toxic and
    SAMPLE_NEGATIVE other ones are used, in the order of a hash of id and text, repeated
    rows once."""
    spark = documents.sparkSession
    known = labels.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    counts = dict(known.groupBy("y").count().collect())  # one row per label
    if not (counts.get(0) and counts.get(1)):
        return None
    share = F.when(F.col("y") == 1, min(1.0, SAMPLE_POSITIVE / counts[1])).otherwise(
        min(1.0, SAMPLE_NEGATIVE / counts[0])
    )
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(F.col("y").isin(0, 1) & (place < share))
    texts = documents.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    with scratch(spark, "toxicity") as folder:
        # At most the sample's ids are broadcast.
        sample = texts.where("text IS NOT NULL").join(F.broadcast(chosen), "id")
        # An id may stand for any number of rows, so the rows are limited as well.
        sample = sample.withColumn("hash", F.xxhash64("id", "text")).dropDuplicates(["y", "hash"])
        sample = sample.withColumn("place", F.row_number().over(Window.partitionBy("y").orderBy("hash")))
        most = F.when(F.col("y") == 1, SAMPLE_POSITIVE).otherwise(SAMPLE_NEGATIVE)
        # The first of the two limits is one that tasks keep before the shuffle.
        sample = sample.where(F.col("place") <= max(SAMPLE_POSITIVE, SAMPLE_NEGATIVE)).where(F.col("place") <= most)
        sample = stage(sample, "sample", folder).select("y", "text")
        n = dict(sample.groupBy("y").count().collect())
        if not (n.get(0) and n.get(1)):
            return None
        seen = sample.mapInArrow(_document_features, "hash bigint, yes bigint, no bigint")
        seen = seen.groupBy("hash").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        yes, no = F.col("yes") / n[1], F.col("no") / n[0]
        rate = (F.col("yes") + F.col("no")) / (n[0] + n[1])
        z = (yes - no) / F.sqrt(rate * (1 - rate) * (1 / n[0] + 1 / n[1]) + 1e-12)
        picked = seen.where((F.col("yes") + F.col("no") >= MIN_DOCUMENTS) & (F.abs(z) >= MIN_Z))
        picked = picked.select("hash").toArrow().column(0).to_numpy()
        picked = np.sort(picked.astype(np.int64).view(np.uint64))
        shared = spark.sparkContext.broadcast(picked)
        bags = sample.mapInArrow(
            lambda batches: _bags(batches, Model(shared.value, np.zeros(len(shared.value)), 0.0)),
            "y int, sentences int, places binary, own binary",
        ).toArrow()
    return fit(sorted(zip(*(c.to_pylist() for c in bags.columns))), picked)


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of documents of each label that hold a feature, per batch."""
    for batch in batches:
        for first, length in slices(batch.column(1)):
            some = batch.slice(first, length)
            labels, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
            every, toxic = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
            for label, text in zip(labels, texts):
                own = np.unique(np.concatenate([h for h, _ in sentence_features(Texts([text]))[3]]))
                every.append(own)
                toxic.append(np.full(len(own), label == 1))
            hashes, which = np.unique(np.concatenate(every), return_inverse=True)
            toxic = np.concatenate(toxic)
            yes = np.bincount(which, weights=toxic, minlength=len(hashes)).astype(np.int64)
            total = np.bincount(which, minlength=len(hashes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(yes), pa.array(total - yes)],
                names=["hash", "yes", "no"],
            )


def _bags(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, length in slices(batch.column(1)):
            some = batch.slice(first, length)
            out = []
            for label, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                owner, _, _, features = sentence_features(Texts([text]))
                places, own = [], []
                for hashes, sentence in features:
                    hit, place = model.places(hashes)
                    places.append(place)
                    own.append(sentence[hit])
                places, own = np.concatenate(places), np.concatenate(own)
                out.append((label, len(owner), places.astype(np.int64).tobytes(), own.astype(np.int64).tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=["y", "sentences", "places", "own"],
            )


def fit(bags: list[tuple], features: np.ndarray) -> Model:
    """Adam on the noisy-or likelihood, weights shrunk by the L1 penalty."""
    y = np.array([b[0] for b in bags])
    sizes = np.array([b[1] for b in bags], np.int64)
    starts = np.cumsum(sizes) - sizes
    places = np.concatenate([np.frombuffer(b[2], np.int64) for b in bags])
    own = np.concatenate([np.frombuffer(b[3], np.int64) + s for b, s in zip(bags, starts)])
    document = np.repeat(np.arange(len(bags)), sizes)
    n, n_sentences = len(features), int(sizes.sum())
    theta = np.append(np.zeros(n), -4.0)
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(own, weights=theta[places], minlength=n_sentences)
        score = 1 / (1 + np.exp(-z))
        total = np.bincount(document, weights=np.logaddexp(0, z), minlength=len(bags))
        # d loss / d total: 1 for clean documents, -e^-t / (1 - e^-t) for toxic ones
        slope = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-3), 1.0)
        pull = slope[document] * score / len(bags)
        gradient = np.append(np.bincount(places, weights=pull[own], minlength=n), pull.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        theta -= move
        shrink = PENALTY * RATE * 10
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - shrink, 0)
    used = theta[:-1] != 0
    return Model(features[used], theta[:-1][used], float(theta[-1]))


def score_texts(texts: Sequence[str], model: Model) -> dict[str, list]:
    laid = Texts(texts)
    owner, place, ends, features = sentence_features(laid)
    z = np.full(len(owner), model.bias)
    for hashes, sentence in features:
        hit, known = model.places(hashes)
        np.add.at(z, sentence[hit], model.weights[known])
    total = np.bincount(owner, weights=np.logaddexp(0, z), minlength=len(texts))
    bad = np.flatnonzero(z >= np.log(SENTENCE_THRESHOLD / (1 - SENTENCE_THRESHOLD)))
    offending = [[] for _ in texts]
    following = np.append(place[1:], len(laid.codes))
    for n in bad.tolist():
        last = int(ends[np.searchsorted(ends, following[n], "right") - 1])
        start = laid.starts[owner[n]]
        offending[owner[n]].append(
            {"start": int(place[n] - start), "end": int(last - start), "score": float(1 / (1 + np.exp(-z[n])))}
        )
    return {"score": -np.expm1(-total), "offending": offending}


SCORES = "score double, predicted int, offending array<struct<start:bigint,end:bigint,score:double>>"


def score(df: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep``, the score of each text, whether it reaches THRESHOLD, and the
    places (code points, from the first to the last word) of its offending sentences."""
    parts = model and (model.features, model.weights, model.bias)
    shared = df.sparkSession.sparkContext.broadcast(parts)

    def make():
        model = shared.value and Model(*shared.value)

        def apply(texts):
            texts = [t or "" for t in texts]
            scores, offending = np.zeros(len(texts)), [[] for _ in texts]
            for part in chunks(texts) if model else ():
                found = score_texts(texts[part], model)
                scores[part], offending[part] = found["score"], found["offending"]
            return {
                "score": scores,
                "predicted": (scores >= THRESHOLD).astype(np.int32),
                "offending": offending,
            }

        return apply

    return map_texts(df, make, SCORES, text, keep)
