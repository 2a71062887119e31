"""Repeated runs of words against comparing all runs of fifty."""

import random
from collections import Counter, defaultdict

from crawltable.llm import passages
from crawltable.llm.passages import MIN_WORDS, WINDOW, remove_runs, repeated_passages


def words_of(text):
    return (text or "").encode().lower().split()


def shared_runs(pairs, size=MIN_WORDS):
    """Places (row, word) where runs of ``size`` words begin that another row has."""
    holders = defaultdict(set)
    for n, (_, text) in enumerate(pairs):
        words = words_of(text)
        for k in range(len(words) - size + 1):
            holders[tuple(words[k : k + size])].add(n)
    found = set()
    for n, (_, text) in enumerate(pairs):
        words = words_of(text)
        starts = range(len(words) - size + 1)
        found |= {(n, k) for k in starts if len(holders[tuple(words[k : k + size])]) > 1}
    return found


def shared(pairs, size=MIN_WORDS):
    return {(n, m) for n, k in shared_runs(pairs, size) for m in range(k, k + size)}


def covered(rows, pairs):
    """The same of the runs in a result; ids are unique."""
    place = {i: n for n, (i, _) in enumerate(pairs)}
    return {(place[r.doc_id], m) for r in rows if r.kind == "run" for m in range(r.place, r.place + r.n_words)}


def corpus():
    """Passages of 46 to 90 words inside, over and between lines of other texts."""
    source = random.Random(11)
    words = [f"W{n}" for n in range(4000)]
    kept = [source.sample(words, n) for n in (46, 49, 50, 51, 55, 64, 74, 90)]
    texts = []
    for n in range(60):
        parts = []
        for passage in source.sample(kept, source.randint(0, 3)):
            parts += source.sample(words, source.randint(0, 40)) + passage
        parts += source.sample(words, source.randint(0, 40))
        for k in range(7, len(parts), source.randint(9, 90)):
            parts[k] += "\n" if n % 2 else "\t"
        texts.append(" ".join(parts))
    texts += [texts[3].lower(), texts[5], texts[5], None, "", "x"]
    return list(enumerate(texts))


def check(spark, pairs):
    df = spark.createDataFrame(pairs, "doc_id bigint, text string").repartition(5)
    rows = repeated_passages(df).collect()
    found = covered(rows, pairs)
    # At either end of a run a few words may lie outside the windows.
    for n, k in shared_runs(pairs):
        assert sum((n, m) in found for m in range(k, k + MIN_WORDS)) >= WINDOW
    assert found <= shared(pairs, WINDOW)
    for r in rows:
        assert r.n_occurrences > 1 and r.n_words >= WINDOW
        assert r.kept_doc_id <= r.doc_id
        assert r.removed == ((r.kept_doc_id, r.kept_place) != (r.doc_id, r.place))
    return rows


def test_runs(spark):
    pairs = corpus()
    assert len(shared(pairs)) > 3000
    check(spark, pairs)


def test_documents(spark, texts):
    rows = check(spark, list(texts.items()))
    # What is reported is repeated: documents without anything shared are left alone.
    lines = {r.doc_id for r in rows if r.kind == "line"}
    pairs = list(texts.items())
    least, most = ({pairs[n][0] for n, _ in shared_runs(pairs, size)} for size in (MIN_WORDS, WINDOW))
    assert lines | least <= {r.doc_id for r in rows} <= lines | most


def test_removal_keeps_one_occurrence(spark):
    """Windows stay whole; a run may lose words at its ends to one that is kept elsewhere."""
    pairs = corpus()
    df = spark.createDataFrame([(i, t, "v") for i, t in pairs], "doc_id bigint, text string, cut string")
    left = {r.doc_id: r.text for r in remove_runs(df.repartition(4)).collect()}
    assert remove_runs(df).columns == df.columns
    before, after = Counter(), Counter()
    for i, text in pairs:
        assert (left[i] is None) == (text is None)
        for kept, bag in ((text, before), (left[i], after)):
            words = words_of(kept)
            bag.update({tuple(words[k : k + MIN_WORDS]) for k in range(len(words) - MIN_WORDS + 1)})
    repeated = {run for run, n in before.items() if n > 1}
    assert repeated and sum(after[run] >= 1 for run in repeated) >= 0.9 * len(repeated)
    assert sum(after[run] for run in repeated) <= 1.25 * len(repeated) < sum(before[run] for run in repeated) / 2
    untouched = {n for n, _ in pairs} - {n for n, _ in shared(pairs, WINDOW)}
    assert untouched and all(left[i] == dict(pairs)[i] for i in untouched)


def test_odd_rows(spark, odd, odd_rows, empty):
    rows = repeated_passages(odd).collect()
    assert rows == []
    twice = repeated_passages(odd.unionByName(odd)).collect()
    long = [i for i, t in odd_rows if len(words_of(t)) >= MIN_WORDS]
    runs = Counter(r.doc_id for r in twice if r.kind == "run")
    assert runs == Counter({i: 2 for i in long})
    assert sum(r.removed for r in twice if r.kind == "run") == len(long)
    assert repeated_passages(empty).count() == 0
    assert sorted(map(repr, remove_runs(odd).collect())) == sorted(map(repr, odd.collect()))
    assert remove_runs(empty).count() == 0
