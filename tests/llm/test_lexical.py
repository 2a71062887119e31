"""Ranked search against a plain version, and the graph of shared terms by itself."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from crawltable.llm import lexical, queries

from conftest import SF_DIR

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def plain_search(documents, items, top=10):
    """Sorted rows (item, rank, doc, score) of lists of (id, text)."""
    bags = [(i, Counter(plain_terms(t))) for i, t in documents]
    bags = [(i, bag, bag.total()) for i, bag in bags if bag]
    size = sum(n for _, _, n in bags)
    df = Counter(term for _, bag, _ in bags for term in bag)
    found = []
    for item, text in items:
        rows = []
        for doc, bag, n in bags:
            m = 25 + 75 * n * len(bags) // size
            score = 0
            for term, times in Counter(plain_terms(text)).items():
                w = math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[term] + 1)))
                score += times * w * (1_000_000_000 * bag[term] // (1000 * bag[term] + 8 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        rows.sort(key=lambda r: r[:3])
        found += [(item, n, doc, -score) for n, (score, _, _, doc) in enumerate(rows[:top], 1)]
    return sorted(found, key=repr)


def rows_of(found):
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("block_terms", [1 << 16, 400])
def test_search(spark, documents, texts, block_terms):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    pairs = [(r.item_id, r.text) for r in items.collect()]
    found = lexical.search(documents.repartition(7), items, block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == plain_search(texts.items(), pairs)


def test_cells_and_copies(spark, monkeypatch):
    """A few documents at a time, most of them copies of one text."""
    monkeypatch.setattr(lexical, "CELLS", 100)
    docs = [(n, "one two two three four" if n % 3 else f"three {n} four five") for n in range(300, 0, -1)]
    items = [(1, "two THREE three"), (2, "four 30 five"), (3, "absent"), (1, "one")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = lexical.search(frame, spark.createDataFrame(items, "item_id bigint, text string"), top=7)
    assert rows_of(found) == plain_search(docs, items, 7)


def test_odd_rows(spark, odd, odd_rows, empty):
    items = [(1, "An ordinary TEXT of words"), (2, None), (3, ""), (None, "word1 again7"), (1, "x"), (1, "x"),
             (4, "漢字 é quick"), (5, " ".join(f"word{n}" for n in range(3000)))]
    asked = spark.createDataFrame([(i, t, "v") for i, t in items], "item_id bigint, text string, score string")
    assert rows_of(lexical.search(odd, asked)) == plain_search(odd_rows, items)
    assert lexical.search(empty, asked).count() == 0
    assert lexical.search(odd, asked.where("false")).count() == 0
    assert lexical.search(odd, asked.where("item_id = 2")).columns == ["item_id", "rank", "doc_id", "score"]


def test_graph_keeps_the_items_and_shares_nodes():
    rng = np.random.default_rng(3)
    common = [[f"c{k}_{n}" for n in range(20)] for k in range(3)]
    lists = [[*common[n % 3], *(f"w{x}" for x in rng.integers(60, size=9)), "a", "a"] for n in range(40)]
    hashes, checks, owner = lexical.terms([" ".join(words) for words in lists])
    rows = []
    for n in range(len(lists)):
        bag = Counter(zip(hashes[owner == n].view(np.int64).tolist(), checks[owner == n].view(np.int64).tolist()))
        rows.append({"item": n, "hashes": [h for h, _ in bag], "checks": [c for _, c in bag], "counts": list(bag.values())})
    kind = pa.list_(pa.int64())
    schema = pa.schema([("item", pa.int64()), ("hashes", kind), ("checks", kind), ("counts", kind)])
    block = lexical.Block(pa.Table.from_pylist(rows, schema))
    base = len(block.term)

    def expanded(node):
        if node < base:
            return Counter({int(block.term[node]): int(block.times[node])})
        assert max(block.left[node - base], block.right[node - base]) < node
        return expanded(block.left[node - base]) + expanded(block.right[node - base])

    for n, row in enumerate(rows):
        total = sum((expanded(r) for r in block.roots[block.starts[n] : block.starts[n + 1]]), Counter())
        number = block.find(np.array(row["hashes"]).view(np.uint64), np.array(row["checks"]).view(np.uint64))
        assert total == Counter(dict(zip(number.tolist(), row["counts"])))
    alone = sum(len(row["hashes"]) for row in rows) - len(rows)
    assert len(block.left) + len(block.roots) - len(rows) < alone / 2
    assert (block.find(np.array([1, 2], np.uint64), np.array([1, 2], np.uint64)) == -1).all()


def test_query(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert rows_of(queries.op12_shared(spark, SF_DIR)) == plain_search(texts.items(), items)
