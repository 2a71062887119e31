"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit a linear classifier over character n-grams
tells the languages with 1 from those with 0. The bits are ridge regressions on n-gram
frequencies, solved together in closed form on a sample of at most SAMPLE_TEXTS labelled
texts, taken evenly from the languages by a hash of id and text, repeated rows once; all
texts are then scored.
Decoding sums a loss of each margin against each codeword, weighted by how well the bit
did on its sample, and takes the nearest codeword; near seconds are flagged.

Null texts and texts without a letter are ``und`` with score 0. Rows with a null
language or a null id are never learned from; the latter count as held out. Repeated
rows keep a row each. Without any labelled text everything is ``und``. Other columns are
not read.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawltable.llm.arrow import map_texts, slices
from crawltable.llm.chars import RollingHash, Texts, chunks
from crawltable.llm.letters import letter_table, lower_table

UNKNOWN = "und"
NGRAMS = (1, 2, 3)
FEATURES = 1 << 14
SAMPLE_TEXTS = 2_000
RIDGE = 0.02
# Margins are sharpened by this before the exponential loss.
SHARPNESS = 2.0
# A second language within this share of the score is flagged.
AMBIGUOUS = 0.6


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 and -1
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray


def codewords(n: int, seed: int = 6) -> np.ndarray:
    """All different splits for up to five languages, else the best of random codes."""
    if n == 1:
        return np.ones((1, 1), int)
    if n <= 5:
        rows = np.array(list(product((1, -1), repeat=n - 1))[1:])
        return np.column_stack([np.ones(len(rows), int), rows]).T
    random, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, distance = None, -1
    for _ in range(50):
        code = random.choice((-1, 1), (n, bits))
        apart = (bits - code @ code.T) // 2 + bits * np.eye(n, dtype=int)
        used = (abs(code.sum(axis=0)) < n).all()
        if used and apart.min() > distance:
            best, distance = code, apart.min()
    if best is None:
        raise ValueError("no code found")
    return best


def held_out(id: str, parts: int, rest: int) -> Column:
    """Whether crc32 of the id's text has this remainder; null ids are held out."""
    remainder = F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % parts
    return F.coalesce(remainder == rest, F.lit(True))


def ngram_features(laid: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature and text of each n-gram of every length; others than letters are spaces,
    and n-grams of spaces only are left out."""
    letters = letter_table()[laid.codes]
    codes = np.where(letters, lower_table()[laid.codes], 32).astype(np.uint32)
    rolling = RollingHash(codes)
    sums = np.concatenate(([0], np.cumsum(letters)))
    owner = np.repeat(np.arange(len(laid.texts)), laid.ends - laid.starts + 1)
    owner[laid.ends] = -1  # the newlines between texts are in no n-gram
    for n in NGRAMS:
        start = np.arange(max(0, len(codes) - n + 1))
        inside = (sums[start + n] > sums[start]) & (owner[start] == owner[start + n - 1])
        start = start[inside]
        yield (rolling.spans(start, start + n) >> np.uint64(50)).astype(np.int64), owner[start]


def learn(df: DataFrame, lang: str = "lang", text: str = "text", id: str = "doc_id") -> Model | None:
    """Fit on ``df``, of which at most SAMPLE_TEXTS rows are used (one per language at
    least)."""
    rows = df.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    rows = rows.withColumn("hash", F.xxhash64("id", "text"))
    # One row per language; repeated rows count once, nearly.
    counts = dict(rows.groupBy("lang").agg(F.approx_count_distinct("hash")).collect())
    if not counts:
        return None
    each = SAMPLE_TEXTS // len(counts) or 1
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.2 * each / n))))
    place = F.pmod("hash", F.lit(1 << 20)) / float(1 << 20)
    first = Window.partitionBy("lang").orderBy("hash")
    sample = rows.where(place < share[F.col("lang")]).dropDuplicates(["lang", "hash"])
    sample = sample.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each).select("lang", "text")
    found = sample.mapInArrow(_counted, "lang string, features binary, counts binary").toArrow()
    languages = sorted(counts)
    codes = codewords(len(languages))
    x = np.zeros((found.num_rows, FEATURES), np.float32)
    which = np.zeros(found.num_rows, int)
    # In an order of their own, so that a fit does not depend on the order of tasks.
    rows_ = sorted(zip(*(c.to_pylist() for c in found.columns)))
    for n, (name, features, values) in enumerate(rows_):
        values = np.frombuffer(values, np.int64)
        x[n, np.frombuffer(features, np.int64)] = values / max(1, values.sum())
        which[n] = languages.index(name)
    seen = np.isin(np.arange(len(languages)), which)
    languages, codes = [k for k, s in zip(languages, seen) if s], codes[seen]
    which = np.cumsum(seen)[which] - 1
    targets = codes[which].astype(np.float32)
    mean, level = x.mean(axis=0), targets.mean(axis=0)
    x -= mean
    kernel = x @ x.T
    scale = max(float(np.trace(kernel)) / len(kernel), 1e-12)
    dual = np.linalg.solve(
        kernel.astype(np.float64) + RIDGE * scale * np.eye(len(kernel)), targets - level
    )
    weights = (x.T @ dual.astype(np.float32)).astype(np.float32)
    bias = level - mean @ weights
    right = np.sign(x @ weights + level) == targets
    trust = np.maximum(2 * right.mean(axis=0) - 1, 0.01)
    return Model(languages, codes, weights, bias, trust)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, length in slices(batch.column(1)):
            some = batch.slice(start, length)
            names, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
            out = []
            for name, text in zip(names, texts):
                values = np.zeros(FEATURES, np.int64)
                for features, _ in ngram_features(Texts([text])):
                    values += np.bincount(features, minlength=FEATURES)
                used = np.flatnonzero(values)
                out.append((name, used.astype(np.int64).tobytes(), values[used].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.binary(), pa.binary()))],
                names=["lang", "features", "counts"],
            )


def margins(texts: Sequence[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Margin of each bit and number of n-grams of each text."""
    laid = Texts(texts)
    sums = np.zeros((len(texts), len(model.bias)))
    totals = np.zeros(len(texts), np.int64)
    for features, owner in ngram_features(laid):
        if not len(owner):
            continue
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        sums[owner[heads]] += np.add.reduceat(model.weights[features], heads, axis=0, dtype=np.float64)
        totals += np.bincount(owner, minlength=len(texts))
    return sums / np.maximum(totals, 1)[:, None] + model.bias, totals


def decode(margin: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword, its score and the second score of each row of margins."""
    agreed = np.clip(margin[:, None, :] * model.codes[None], -2, 2) * SHARPNESS
    loss = (np.exp(-agreed) * model.trust).sum(axis=2) / model.trust.sum()
    odds = np.exp(loss.min(axis=1, keepdims=True) * 4 - loss * 4)
    scores = odds / odds.sum(axis=1, keepdims=True)
    best = scores.argmax(axis=1)
    rows = np.arange(len(best))
    score = scores[rows, best]
    scores[rows, best] = 0
    return best, score, scores.max(axis=1)


def identify(df: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and lang_pred, score and ``ambiguous`` of every row."""
    parts = model and (model.languages, model.codes, model.weights, model.bias, model.trust)
    shared = df.sparkSession.sparkContext.broadcast(parts)

    def make():
        model = shared.value and Model(*shared.value)

        def apply(texts):
            texts = [t or "" for t in texts]
            names, score, flagged = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            for part in chunks(texts) if model else ():
                margin, totals = margins(texts[part], model)
                best, first, second = decode(margin, model)
                for n in np.flatnonzero(totals):
                    at = part.start + n
                    names[at], score[at] = model.languages[best[n]], first[n]
                    flagged[at] = second[n] > AMBIGUOUS * first[n]
            return {"lang_pred": names, "score": score, "ambiguous": flagged}

        return apply

    return map_texts(df, make, "lang_pred string, score double, ambiguous boolean", text, keep)
