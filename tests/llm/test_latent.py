"""Leaks against searching for every item in every text."""

import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from crawltable.llm import latent
from crawltable.llm.latent import common_words, drop_leaks, find_leaks, singular_vectors

SF_DIR = "/root/testdata/sf0.001"


def plain(text):
    return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "


def held(texts, items):
    return {(i, k) for k, q in items for i, t in texts if plain(q) in plain(t)}


def test_documents(spark, documents, texts):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    rows = find_leaks(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == held(texts.items(), items)
    for r in rows:
        inside = plain(texts[r.doc_id][r.start : r.end])
        assert plain(dict(items)[r.item_id]) in inside
    kept = drop_leaks(documents, benchmark)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == texts.keys() - {r.doc_id for r in rows}


def made_up(seed=4):
    """Texts with items in them, whole, reworded and cut, and texts without."""
    source = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfklmnprst" for b in "aeiou" for c in "lmnrst"]
    common = words[:30]

    def prose(n):
        return [source.choice(common if source.random() < 0.6 else words) for _ in range(n)]

    items = [prose(source.randint(12, 150)) for _ in range(30)]
    texts, truth = [], set()
    for n in range(200):
        text = prose(source.randint(0, 300))
        if n % 4 == 0:
            item = n // 4 % 30
            own = list(items[item])
            if n % 8 == 0:  # one word in ten is another one
                for k in range(0, len(own) - 6, 10):
                    own[k] = source.choice(words)
            place = source.randint(0, len(text))
            text[place:place] = own
            truth.add((n, item))
        texts.append((n, " ".join(text).capitalize() + "."))
    return texts, [(k, " ".join(item) + "?") for k, item in enumerate(items)], truth


@pytest.mark.parametrize("per_block", [400, 7])
def test_reworded_items_are_found(spark, monkeypatch, per_block):
    monkeypatch.setattr(latent, "ITEMS", per_block)
    texts, items, truth = made_up()
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(df, benchmark).collect()} == truth
    kept = {r.doc_id for r in drop_leaks(df, benchmark).collect()}
    assert kept == {i for i, _ in texts} - {i for i, _ in truth}


def test_odd_rows(spark, odd, odd_rows, empty):
    item = "An ordinary text of more than ten words that stands here twice"
    rows = [(1, None), (2, ""), (3, "one two"), (None, item), (4, item), (4, item), (5, " \n")]
    benchmark = spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "text AS doc_id")
    found = find_leaks(odd, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, k) for i in (None, 5) for k in (None, 4)}
    assert drop_leaks(odd, benchmark).count() == len(odd_rows) - 4
    assert find_leaks(empty, benchmark).count() == 0 and drop_leaks(empty, benchmark).columns == odd.columns
    nothing = benchmark.where("false")
    assert find_leaks(odd, nothing).count() == 0 and drop_leaks(odd, nothing).count() == len(odd_rows)


@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), max_size=20))
def test_longest_common_subsequence(one, two):
    table = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    for i, a in enumerate(one):
        for j, b in enumerate(two):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    assert common_words(one, two) == table[-1][-1]


def test_singular_vectors():
    random_ = np.random.default_rng(1)
    a = random_.standard_normal((300, 6)) @ random_.standard_normal((6, 80))
    sketch = a.T @ a @ (other := random_.standard_normal((80, 12)))
    vectors = singular_vectors(sketch, other)[:, :6].astype(float)
    _, _, exact = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(np.linalg.svd(exact[:6] @ vectors)[1], 1, atol=1e-3)
