"""Hard negatives against a plain version; bounds by themselves."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawltable.llm import queries, segments

from conftest import SF_DIR

SCHEMA = "vec_id bigint, label int, embedding array<float>, score string, slot string"


def plain_mine(rows, is_anchor):
    """Of (id, label, vector); copies are other rows."""
    kept = []
    for n, (i, label, vector) in enumerate(rows):
        good = i is not None and label is not None and vector is not None
        if good and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((n, i, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for n, anchor, label, vector in kept:
        if not is_anchor(anchor):
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, la) for m, i, la, v in kept if m != n]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fit = sorted(s for s in scored if s[2] != label and 50 * p >= 100 * s[0] >= 95 * p)
            found += [(anchor, positive, k, i, -p, -s) for k, (s, i, _) in enumerate(fit[:3], 1)]
    return sorted(found)


def rows_of(found):
    return sorted(map(tuple, found.collect()))


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, "x") for r in rows], SCHEMA).repartition(4)


def clustered(n, seed, width=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width)) + 0.7
    picks = rng.integers(4, size=n)
    vectors = (centres[picks] + rng.normal(size=(n, width)) * 0.4).astype(np.float32)
    return [(i, int(picks[i] if rng.random() < 0.7 else rng.integers(4)), vectors[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("block_bytes,cells", [(1 << 25, 1 << 21), (20_000, 700)])
def test_mine(spark, monkeypatch, block_bytes, cells):
    monkeypatch.setattr(segments, "CELLS", cells)
    rows = clustered(400, 5)
    found = segments.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=block_bytes)
    expected = plain_mine(rows, lambda i: i % 10 == 0)
    assert rows_of(found) == expected and len(expected) > 300


def test_copies_and_ties(spark):
    """A third of the rows are one vector, under two labels; some rows come twice."""
    rows = clustered(240, 6, width=3)
    rows = [(i, la, [1.0, 0.5, 0.25] if i % 3 == 0 else v) for i, la, v in rows]
    rows += rows[:40]
    found = segments.mine(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert rows_of(found) == plain_mine(rows, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, [1.0]), (2, 2, [0.7, 0.1]), (3, 2, [0.6, 9.0, 3.0]), (4, None, [0.6, 0.0]),
        (5, 2, None), (None, 2, [0.8, 0.0]), (6, 2, [0.8, None]), (7, 2, [nan, 0.5]), (8, 2, [0.8, -inf]),
        (9, 2, []), (10, 3, [-1.0, 0.0]), (20, 3, [-0.5, 0.0]), (30, 4, []), (40, 4, [0.0]), (11, 1, [1e12, 0.0]),
        (50, 5, [1e6, 1.0]), (51, 5, [1e6, 1.0]), (52, 6, [0.9e6, 3.0]),
    ]
    padded = [(i, la, v if v is None else v + [0.0] * (3 - len(v))) for i, la, v in rows]
    found = segments.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert rows_of(found) == plain_mine(padded, lambda i: i % 10 == 0)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    empty = segments.mine(frame(spark, rows).where("false"), F.col("vec_id") % 10 == 0)
    assert empty.columns == found.columns and empty.count() == 0
    assert segments.mine(frame(spark, rows), F.lit(None).cast("boolean")).count() == 0


def test_bounds_hold_and_get_tighter(spark):
    rows = clustered(200, 7, width=64)
    points = segments.Points(
        segments.summarised(frame(spark, rows), F.lit(True), "vec_id", "label", "embedding").toArrow()
    )
    exact = points.vectors @ points.vectors.T
    widths = []
    for level in segments.LEVELS:
        centre = points.means[level] @ points.means[level].T
        spread = points.deviations[level] @ points.deviations[level].T
        assert (np.abs(exact - centre) <= spread + 1e-6 * np.abs(exact) + 1e-3).all()
        widths.append(spread.mean())
    assert widths == sorted(widths, reverse=True) and widths[-1] < 0.9 * widths[0]
    everyone = np.arange(len(points.row))
    low = np.sort(exact, axis=1)[:, -6]
    i, j, scores = segments.within(points, points, everyone, everyone, low, np.full(len(low), 1 << 60))
    assert (exact[i, j] == scores).all()
    assert len(i) == (exact >= low[:, None]).sum()


def test_query(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label, r.embedding) for r in vectors]
    assert rows_of(queries.op11_segments(spark, SF_DIR)) == plain_mine(rows, lambda i: i % 50 == 0)
