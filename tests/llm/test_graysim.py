"""Fingerprints, links and groups against plain loops."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from crawltable.llm import components as rounds
from crawltable.llm import graysim
from crawltable.llm.components import components


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in linked:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def near(values, limit=2):
    values = sorted(set(values))
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= limit]


def test_documents(documents, texts):
    rows = graysim.near_duplicates(documents).collect()
    prints = {i: fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint & graysim._ALL for r in rows} == prints
    roots = groups(set(prints.values()), near(prints.values()))
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    assert {r.doc_id: r.component_id for r in rows} == {i: least[roots[p]] for i, p in prints.items()}


def test_odd_rows(odd, odd_rows, empty):
    rows = graysim.near_duplicates(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd_rows)
    found = {(r.doc_id, r.fingerprint & graysim._ALL): r.component_id for r in rows}
    assert set(found) == {(i, fingerprint(t)) for i, t in odd_rows}
    assert found[6, 0] == 1 and found[3, 0] == 1 and found[None, 0] == 1
    assert graysim.near_duplicates(empty).count() == 0


def test_one_row_of_each_group_is_kept(odd, odd_rows, empty, documents):
    kept = graysim.keep_one(odd)
    assert kept.columns == odd.columns
    prints = {fingerprint(t) for _, t in odd_rows}
    assert kept.count() == len(set(groups(prints, near(prints)).values()))
    # One of the three equal texts, and the longer one that shares their id.
    assert Counter(r.doc_id for r in kept.collect())[5] == 2
    assert graysim.keep_one(empty).count() == 0
    whole = graysim.near_duplicates(documents).select("component_id").distinct()
    assert {r.doc_id for r in graysim.keep_one(documents).collect()} == {r[0] for r in whole.collect()}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 400), st.integers(1, 12))
def test_searches_lose_nothing(seed, n, spread):
    """Dense and scattered fingerprints; groups as well as single ones."""
    source = random.Random(seed)
    centres = [source.getrandbits(64) for _ in range(1 + n // 20)]
    values = []
    for _ in range(n):
        value = source.choice(centres)
        for _ in range(source.randint(0, spread)):
            value ^= 1 << source.randrange(64)
        values.append(value)
    values = np.array(sorted(set(values)), np.uint64)
    tree = graysim.Tree(values, values)
    found = {
        (int(values[q]), int(tree.members[m]))
        for queries, items in tree.search(values, 2)
        for q, m in zip(queries, items)
    }
    wanted = {(int(a), int(b)) for a in values for b in values if (int(a) ^ int(b)).bit_count() <= 2}
    assert found == wanted


@pytest.mark.parametrize("slices", ["1", "7", "40"])
def test_links_over_many_slices(spark, slices):
    source = random.Random(5)
    values = {source.getrandbits(64) for _ in range(300)}
    dense = source.getrandbits(64)
    for _ in range(400):
        value = dense
        for _ in range(source.randint(0, 6)):
            value ^= 1 << source.randrange(64)
        values.add(value)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    points = spark.createDataFrame(signed, "fingerprint bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        edges = [(r.a & graysim._ALL, r.b & graysim._ALL) for r in graysim.links(points).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(a in values and b in values for a, b in edges)
    assert groups(values, edges) == groups(values, near(values))


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    source = random.Random(3)
    edges = {
        "chain": [(n, n + 1) for n in range(200)],
        "star": [(500, n) for n in range(300)] + [(500, 500), (None, 3), (900, None)],
        "random": [(source.randrange(400), source.randrange(400)) for _ in range(300)],
        "none": [(7, 7), (None, None)],
    }[shape]
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == groups({n for e in real for n in e}, real)


@pytest.mark.parametrize("per_task", [50_000, 20])
def test_files_of_a_round_follow_its_rows(spark, monkeypatch, per_task):
    """However many shuffle partitions there are: check_h has 211 of them for few links."""
    files, keep = {}, rounds.stage

    def counted(df, label, folder=None):
        staged = keep(df, label, folder)
        files[label] = len(staged.inputFiles())
        return staged

    monkeypatch.setattr(rounds, "stage", counted)
    monkeypatch.setattr(rounds, "ROWS_PER_TASK", per_task, raising=False)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    edges = [(n, n + 1 + n % 3) for n in range(0, 900, 2)]
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == groups({n for e in edges for n in e}, edges)
    most = max(n for label, n in files.items() if label.startswith(("large", "hung", "small")))
    assert most <= 8 if per_task > 20 else 20 < most <= 45
