"""Ids and decoded texts against the library's own, for every path of the join."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crawltable.llm import queries, wordtable
from crawltable.llm.tokens import tokenizer, vocabulary_path

from conftest import CLASHING, SF_DIR

TRICKY = [
    "İstanbul ΣΑΣ ß Ǆ ﬀ Å Å é ẞ", "it's we'll I'D they'RE 'x 'tis", "<|endoftext|>a<|startoftext|><|endoftext|> b <|EndOfText|>",
    "à́b‍c \U0001f468‍\U0001f469 ½²٣ x1y22", "\x00\x01 \x7f\x85  tab\there  nbsp", "漢字かな交じり文 한국어",
    "x" * 3000 + " " + "y1" * 500,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def tricky(spark):
    return spark.createDataFrame(list(enumerate(TRICKY)), "doc_id bigint, text string")


def by_text(rows, ids="ids"):
    return sorted(((r.text or "", tuple(r[ids])) for r in rows), key=repr)


def whole(library, texts):
    pairs = ((t or "", tuple(library.encode(t or "", add_special_tokens=False).ids)) for t in texts)
    return sorted(pairs, key=repr)


@pytest.mark.parametrize("head_words,bits", [(1 << 20, 64), (500, 64), (0, 64), (1 << 20, 11), (500, 11)])
def test_ids(documents, tricky, library, head_words, bits):
    rows = documents.select("doc_id", "text").unionByName(tricky)
    found = wordtable.encode(rows, head_words=head_words, bits=bits).collect()
    assert by_text(found) == whole(library, [r.text for r in rows.collect()])


def test_partitions_may_change(documents, library, monkeypatch):
    """Words that nobody asked for are encoded where they stand."""
    monkeypatch.setattr(wordtable, "_parts", lambda df, keep, text, kept=wordtable._parts: kept(df, keep, text).withColumn(
        "_part", F.col("_part") + (len(keep) > 0).real))
    found = wordtable.encode(documents.repartition(3), head_words=100, keep=["text"]).collect()
    assert by_text(found) == whole(library, [r.text for r in documents.collect()])


def test_distinct_words_are_encoded_once(documents, library):
    words = wordtable.distinct_words(documents.repartition(5)).collect()
    assert len({w.word for w in words}) == len(words) == len({w.hash for w in words})
    total = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) for r in documents.collect())
    assert sum(w.n * len(w.ids) for w in words) == total


@pytest.mark.parametrize("head_words", [1 << 20, 3])
def test_odd_rows(odd, odd_rows, empty, library, head_words):
    encoded = wordtable.encode(odd, ids="hash", head_words=head_words, keep=["doc_id", "row", "id", "text"])
    decoded = wordtable.decode(encoded, ids="hash", decoded="holes")
    assert decoded.columns == ["doc_id", "row", "id", "text", "hash", "holes"]
    rows = decoded.collect()
    assert sorted(r.row or "" for r in rows) == sorted(r.row or "" for r in odd.collect())
    assert by_text(rows, "hash") == whole(library, [t for _, t in odd_rows])
    for r in rows:
        assert r.holes == library.decode(r.hash, skip_special_tokens=False)
    assert wordtable.decode(wordtable.encode(empty, head_words=head_words)).count() == 0
    assert wordtable.encode(odd).columns == ["doc_id", "text", *CLASHING, "ids"]


def test_other_vocabularies(documents, tricky):
    path = vocabulary_path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    rows = documents.limit(60).select("doc_id", "text").unionByName(tricky)
    for head_words in (1 << 20, 100):
        found = wordtable.decode(wordtable.encode(rows, vocabulary=path, head_words=head_words), vocabulary=path).collect()
        for r in found:
            assert r.ids == other.encode(r.text or "", add_special_tokens=False).ids
            assert r.decoded == other.decode(r.ids, skip_special_tokens=False)
    texts = [r.text for r in found]
    for ids, text in zip(tokenizer(path).encode(texts), texts):
        assert ids.tolist() == other.encode(text or "", add_special_tokens=False).ids


def test_unknown_ids_fail(spark):
    rows = spark.createDataFrame([(1, [5, None]), (2, [10])], "doc_id int, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        wordtable.decode(rows).collect()
    null = spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in wordtable.decode(null).collect()} == {1: None, 2: ""}


def test_query(spark, texts, library):
    rows = {r.doc_id: r for r in queries.op13_wordtable(spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decimal = " ".join(map(str, ids)).encode()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(decimal).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(decoded).hexdigest()


def test_ids_go_to_python_once(spark, library):
    ids = spark.range(3).selectExpr("id", "sequence(300, 340) AS ids")
    decoded = wordtable.decode(ids)
    assert "_ids" not in decoded._jdf.queryExecution().optimizedPlan().toString()
    expected = library.decode(list(range(300, 341)), skip_special_tokens=False)
    assert [r.decoded for r in decoded.collect()] == [expected] * 3
    over = wordtable.decode(ids, decoded="ids")
    assert [r.ids for r in over.collect()] == [expected] * 3


def test_texts_come_in_small_batches(spark, tmp_path, monkeypatch):
    """Twelve texts of a megabyte, which are one batch for Spark."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(150_000)), lambda i: F.concat(F.lit("w"), i.cast("string"))))
    texts = spark.range(12, numPartitions=1).select(F.col("id").alias("doc_id"), words.alias("text"))
    texts.write.parquet(str(tmp_path / "documents.parquet"))
    slices = wordtable.slices

    def bounded(column):
        if column.nbytes > 6 << 20:
            raise ValueError(f"a batch of {column.nbytes} bytes")
        return slices(column)

    monkeypatch.setattr(wordtable, "slices", bounded)
    rows = queries.op13_wordtable(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(12)) and len({r.ids_sha256 for r in rows}) == 1
