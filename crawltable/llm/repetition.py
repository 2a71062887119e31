"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find the words that lie in an n-gram found
twice or more in the same text; the characters of these words, and of lines equal to
an earlier line, are measured against all characters of words. All of it is numpy over
chunks of texts, no shuffle is needed, and a text is never cut.

Null or empty texts have no words and fail the base rules. Repeated rows and null ids
are kept as they are, one result each; other columns of the table are not read.
"""

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawltable.llm.arrow import map_texts
from crawltable.llm.chars import RollingHash, Texts, chunks, mixed

SYMBOLS = "#*$%&|<>"
BASE_NGRAM = 5

COLUMNS = """n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,
  n_repeat_words bigint, dup_line_chars bigint, dup_ngram_chars array<bigint>"""


@dataclass(frozen=True)
class Rules:
    """Limits; shares are in percent of the characters in words.

    ``ngrams`` maps a length in words to the largest share of characters that may lie
    in n-grams of that length found twice or more; ``max_symbols`` is per 100 words.
    """

    min_words: int = 10
    max_repeat_words: int = 20
    max_dup_line_chars: int = 30
    max_symbols: int = 10
    ngrams: dict[int, int] = field(
        default_factory=lambda: {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}
    )


def measure_repetition(
    df: DataFrame, rules: Rules = Rules(), id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts of each text; ``dup_ngram_chars`` is in the order of ``rules.ngrams``."""
    lengths = sorted(rules.ngrams)

    def make():
        def apply(texts):
            texts = [t or "" for t in texts]
            parts = [measure(texts[part], lengths) for part in chunks(texts)]
            joined = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            joined["dup_ngram_chars"] = list(joined["dup_ngram_chars"])
            return joined

        return apply

    return map_texts(df, make, COLUMNS, text, [id])


def judge(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add ``base_failed`` and ``kept``."""
    chars = F.col("word_chars")
    base = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_words * F.col("n_words")
    )
    bad = 100 * F.col("dup_line_chars") > rules.max_dup_line_chars * chars
    bad |= 100 * F.col("n_symbols") > rules.max_symbols * F.col("n_words")
    for n, length in enumerate(sorted(rules.ngrams)):
        bad |= 100 * F.col("dup_ngram_chars")[n] > rules.ngrams[length] * chars
    return measured.withColumns({"base_failed": base, "kept": ~base & ~bad})


def keep_quality(df: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text passes, all columns as they were."""
    lengths = sorted(rules.ngrams)
    place = df.columns.index(text)

    def run(batches):
        import pyarrow as pa

        from crawltable.llm.arrow import slices

        for batch in batches:
            for start, length in slices(batch.column(place)):
                part = batch.slice(start, length)
                texts = [t or "" for t in part.column(place).to_pylist()]
                passed = [_passes(measure(texts[c], lengths), rules) for c in chunks(texts)]
                yield part.filter(pa.array(np.concatenate(passed)))

    return df.mapInArrow(run, df.schema)


def _passes(found: dict[str, np.ndarray], rules: Rules) -> np.ndarray:
    chars = found["word_chars"]
    limits = np.array([rules.ngrams[n] for n in sorted(rules.ngrams)])
    bad = found["n_words"] < rules.min_words
    bad |= 100 * found["n_repeat_words"] > rules.max_repeat_words * found["n_words"]
    bad |= 100 * found["dup_line_chars"] > rules.max_dup_line_chars * chars
    bad |= 100 * found["n_symbols"] > rules.max_symbols * found["n_words"]
    bad |= (100 * found["dup_ngram_chars"] > limits * chars[:, None]).any(axis=1)
    return ~bad


def measure(texts: list[str], lengths: list[int]) -> dict[str, np.ndarray]:
    laid, n = Texts(texts), len(texts)
    start, end = laid.words()
    owner, size = laid.owner(start), end - start
    rolling = RollingHash(laid.codes)
    covered = _covered(rolling.spans(start, end), owner, {BASE_NGRAM, *lengths})

    def per_text(values, where=owner):
        return np.bincount(where, weights=values, minlength=n).astype(np.int64)

    symbols = np.isin(laid.codes, [ord(c) for c in SYMBOLS])
    line_start, line_end = laid.lines()
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_owner = laid.owner(line_start)
    again = _seen_before(rolling.spans(line_start, line_end), line_owner)
    return {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": per_text(size),
        "n_symbols": laid.count(symbols),
        "n_dup_lines": per_text(again, line_owner),
        "n_repeat_words": per_text(covered[BASE_NGRAM]),
        "dup_line_chars": per_text(again * (line_end - line_start), line_owner),
        "dup_ngram_chars": np.stack([per_text(covered[k] * size) for k in lengths], axis=1),
    }


def _keyed(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Different hashes in different texts."""
    return hashes ^ mixed(owner.astype(np.uint64) + np.uint64(1))


def _covered(words: np.ndarray, owner: np.ndarray, lengths: set[int]) -> dict[int, np.ndarray]:
    """For each length the words inside an n-gram that its text holds twice or more."""
    step = np.uint64(0x9E3779B97F4A7C15)
    found, rolling, total = {}, words, len(words)
    for length in range(1, max(lengths) + 1):
        if length > 1:  # one word more: shift the shorter window and add its next word
            last = max(0, total - length + 1)
            rolling = rolling[:last] * step + words[length - 1 : length - 1 + last]
        if length not in lengths:
            continue
        within = np.flatnonzero(owner[: len(rolling)] == owner[length - 1 :][: len(rolling)])
        keys = _keyed(mixed(rolling[within]), owner[within])
        order = np.argsort(keys)
        ordered = keys[order]
        equal = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        edges = np.zeros(total + 1, np.int64)
        hits = within[twice]
        edges[hits] += 1
        edges[hits + length] -= 1
        found[length] = np.cumsum(edges[:total]) > 0
    return found


def _seen_before(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    keys = _keyed(hashes, owner)
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return again
