"""Quality rules against plain counting."""

import re
from collections import Counter

import duckdb
from hypothesis import given
from hypothesis import strategies as st

from crawltable.llm import oracle
from crawltable.llm.repetition import Rules, judge, keep_quality, measure, measure_repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LENGTHS = sorted(Rules().ngrams)


def counted(text):
    text = text or ""
    words = WORD.findall(text)

    def covered(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        seen = Counter(grams)
        return {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(n)}

    lines = Counter(line for line in text.split("\n") if WORD.search(line))
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(n - 1 for n in lines.values()),
        "n_repeat_words": len(covered(5)),
        "dup_line_chars": sum((n - 1) * len(line) for line, n in lines.items()),
        "dup_ngram_chars": [sum(len(words[i]) for i in covered(n)) for n in LENGTHS],
    }


def passes(c):
    words, chars, rules = c["n_words"], c["word_chars"], Rules()
    base = words < 10 or 100 * c["n_repeat_words"] > 20 * words
    bad = 100 * c["dup_line_chars"] > 30 * chars or 100 * c["n_symbols"] > 10 * words
    bad = bad or any(100 * x > rules.ngrams[n] * chars for n, x in zip(LENGTHS, c["dup_ngram_chars"]))
    return base, not base and not bad


def check(row, text):
    expected = counted(text)
    base, kept = passes(expected)
    assert row.asDict() | {"doc_id": 0} == expected | {"doc_id": 0, "base_failed": base, "kept": kept}


def test_documents(documents, texts):
    rows = judge(measure_repetition(documents)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        check(row, texts[row.doc_id])


def test_odd_rows(odd, odd_rows, empty):
    rows = judge(measure_repetition(odd)).collect()
    by_id = Counter(r.doc_id for r in rows)
    assert by_id == Counter(i for i, _ in odd_rows)
    for i, text in odd_rows:
        if by_id[i] == 1:
            check(next(r for r in rows if r.doc_id == i), text)
    assert judge(measure_repetition(empty)).count() == 0
    assert keep_quality(empty).columns == empty.columns


@given(st.lists(st.text(alphabet="ab \n#", max_size=60), min_size=1, max_size=4))
def test_small_texts(texts):
    found = measure(texts, LENGTHS)
    for n, text in enumerate(texts):
        assert {k: v[n].tolist() for k, v in found.items()} == counted(text)


def test_keeping_agrees_with_judging(documents, odd):
    for df in (documents, odd):
        kept = keep_quality(df)
        assert kept.columns == df.columns
        judged = judge(measure_repetition(df)).where("kept").count()
        assert kept.count() == judged


def test_sql(documents):
    duck = duckdb.connect()
    duck.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    theirs = duck.execute(oracle.quality()).fetchall()
    names = [d[0] for d in duck.description]
    ours = judge(measure_repetition(documents)).select(*names).collect()
    assert sorted(map(tuple, ours)) == sorted(theirs)
