"""Repeated paragraphs against comparing all pairs."""

import random
from collections import defaultdict

from crawltable.llm import paragraphs
from crawltable.llm.paragraphs import remove_repeated, repeated_paragraphs, shingle_set, tune_bands

from test_graysim import groups


def brute(pairs, min_words=10):
    """(id, line) to its component's occurrences, for lines that have another one."""
    places = [
        (i, n, line)
        for i, text in pairs
        for n, line in enumerate((text or "").split("\n"))
        if len(line.encode().split()) >= min_words
    ]
    sets = [shingle_set(line) for _, _, line in places]
    holders = defaultdict(set)
    for k, one in enumerate(sets):
        for shingle in one:
            holders[shingle].add(k)
    linked = []
    for k, one in enumerate(sets):
        for other in {o for s in one for o in holders[s] if o < k}:
            common = len(one & sets[other])
            if common >= 0.8 * (len(one) + len(sets[other]) - common):
                linked.append((k, other))
    roots = groups(range(len(places)), linked)
    members = defaultdict(list)
    for k, root in roots.items():
        members[root].append(places[k][:2])
    return {m: sorted(found) for found in members.values() if len(found) > 1 for m in found}


def check(rows, expected):
    assert {(r.doc_id, r.paragraph) for r in rows} == set(expected)
    for r in rows:
        group = expected[r.doc_id, r.paragraph]
        assert (r.kept_doc_id, r.kept_paragraph) == group[0]
        assert r.n_occurrences == len(group)
        assert r.removed == ((r.doc_id, r.paragraph) != group[0])


def test_documents(documents, texts):
    check(repeated_paragraphs(documents).collect(), brute(texts.items()))


def near_copies():
    """Groups of near copies, and pairs of groups that lie between linked and not."""
    source = random.Random(9)
    words = [f"w{n}" for n in range(3000)]
    texts = []
    for group in range(12):
        base = source.sample(words, 80)
        for _ in range(15):
            copy = list(base)
            for _ in range(source.randint(0, 6)):
                copy[source.randrange(len(copy))] = source.choice(words)
            texts.append(" ".join(copy))
    return list(enumerate(texts))


def test_near_copies(spark):
    pairs = near_copies()
    rows = repeated_paragraphs(spark.createDataFrame(pairs, "doc_id bigint, text string")).collect()
    check(rows, brute(pairs))


def crowd(n):
    """Edited copies of one line: many pairs lie just below or above the limit."""
    source = random.Random(n)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(n):
        copy = list(base)
        for _ in range(source.randint(0, 4)):
            copy[source.randrange(60)] = f"v{source.randrange(12)}"
        texts.append(" ".join(copy))
    return list(enumerate(texts))


def test_crowded_buckets_in_cells(spark, monkeypatch):
    """Several cells a bucket lose no link."""
    monkeypatch.setattr(paragraphs, "PAIRED", 3)
    monkeypatch.setattr(paragraphs, "BLOCK_UNITS", 20)
    monkeypatch.setattr(paragraphs, "AT_A_TIME", 7)
    for pairs in (crowd(90), near_copies()):
        rows = repeated_paragraphs(spark.createDataFrame(pairs, "doc_id bigint, text string")).collect()
        check(rows, brute(pairs))


def test_pairs_of_a_group_are_few(spark, monkeypatch):
    """The rows made of pairs are some for each unit of a group, not one for each pair."""
    made = {}
    stage = paragraphs.stage

    def counted(df, label, *folder):
        staged = stage(df, label, *folder)
        if label in ("pairs", "rest"):
            made[label] = staged.count()
        return staged

    monkeypatch.setattr(paragraphs, "stage", counted)
    repeated_paragraphs(spark.createDataFrame(crowd(400), "doc_id bigint, text string"))
    assert 0 < sum(made.values()) <= 10 * 400


def chains():
    """Copies of copies: neighbours are similar, the ends of a chain are not."""
    source = random.Random(2)
    words = [f"w{n}" for n in range(3000)]
    texts = []
    for _ in range(4):
        line = source.sample(words, 60)
        for _ in range(12):
            line = list(line)
            line[source.randrange(60)] = source.choice(words)
            texts.append(" ".join(line))
    source.shuffle(texts)
    return list(enumerate(texts))


def test_chains_are_one_component(spark):
    pairs = chains()
    rows = repeated_paragraphs(spark.createDataFrame(pairs, "doc_id bigint, text string")).collect()
    check(rows, brute(pairs))


def test_odd_rows(odd, odd_rows, empty):
    rows = repeated_paragraphs(odd).collect()
    same = [r for r in rows if r.n_words == 15 or r.n_words == 17]
    assert {r.doc_id for r in same} == {None, 5}
    assert all(r.kept_doc_id == 5 for r in same)
    assert repeated_paragraphs(empty).count() == 0
    assert remove_repeated(empty).columns == empty.columns


def test_removal(spark, documents, texts):
    found = repeated_paragraphs(documents)
    cut = {r.doc_id: r.text for r in remove_repeated(documents).collect()}
    assert cut.keys() == texts.keys()
    gone = defaultdict(set)
    for r in found.where("removed").collect():
        gone[r.doc_id].add(r.paragraph)
    for i, text in texts.items():
        lines = text.split("\n")
        assert cut[i] == "\n".join(x for n, x in enumerate(lines) if n not in gone[i])


def test_bands_reach_their_recall():
    bands, rows = tune_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert 1 - (1 - 0.4**rows) ** bands <= 0.33
    assert paragraphs.SIMILARITY == 0.8 and paragraphs.SHINGLE_WORDS == 5


LINE = "one line of a good dozen words that comes again in other texts as well"


def test_rows_with_one_id_are_told_apart(spark):
    """Of equal rows one keeps the paragraph; another text of the same id is left alone."""
    other = "another line of some ten words or more that is not repeated anywhere"
    rows = spark.createDataFrame([(5, LINE), (5, LINE), (5, other), (7, LINE), (None, other[::-1])], "doc_id bigint, text string")
    found = repeated_paragraphs(rows.repartition(3)).collect()
    assert sorted((r.doc_id, r.removed) for r in found) == [(5, False), (5, True), (7, True)]
    left = sorted((r.doc_id or 0, r.text) for r in remove_repeated(rows).collect())
    assert left == sorted([(0, other[::-1]), (5, ""), (5, LINE), (5, other), (7, "")])
