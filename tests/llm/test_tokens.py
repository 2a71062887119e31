"""Token ids by word, token files and packed sequences."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crawltable.llm import powers, simple8b
from crawltable.llm.tokens import WordTokenizer, vocabulary_path


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(vocabulary_path())


def ids_of(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, 1]


def test_documents_have_the_ids_of_the_library(words, plain, texts):
    for text, ids in zip(texts.values(), words.encode(list(texts.values()))):
        assert ids.tolist() == ids_of(plain, text)[:-1]


ALPHABET = "ab'sStTreLl 1²½\n\t\r\x0b\x1c\x85\xa0éÉéßİıΣσ-_.,<|>漢​\U0001f600"


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=3))
def test_any_text_has_the_ids_of_the_library(words, plain, texts):
    texts = [*texts, "<|endoftext|>" + texts[0]]
    for text, ids in zip(texts, words.encode(texts)):
        assert ids.tolist() == ids_of(plain, text)[:-1]


@given(
    st.lists(
        st.integers(0, 3) | st.integers(0, 1 << 16) | st.integers(0, (1 << 64) - 1) | st.just(0),
        max_size=400,
    )
)
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    encoded, offsets = simple8b.encode_blocks(values)
    assert len(offsets) - 1 == -(-len(values) // simple8b.BLOCK)
    assert (simple8b.decode_blocks(encoded, offsets, len(values)) == values).all()


def test_words_are_packed_as_densely_as_selectors_allow():
    for value, per_word in ((0, 120), (1, 60), (3, 30), (1000, 6), (40_000, 3), (1 << 40, 1)):
        encoded, _ = simple8b.encode_blocks(np.full(simple8b.BLOCK, value, np.uint64))
        assert len(encoded) == -(-simple8b.BLOCK // per_word)
    assert len(simple8b.encode_blocks(np.full(5, 1 << 61, np.uint64))[0]) == 10


def test_cut_files_fail():
    data = simple8b.write_file([1], np.array([3]), np.array([1, 2, 3], np.uint64))
    with pytest.raises(ValueError):
        simple8b.read_file(data[:-8])
    with pytest.raises(ValueError):
        simple8b.read_file(b"xxxx" + data[4:])


@pytest.mark.parametrize("file_values", [1000, 4_000_000])
def test_token_files(spark, documents, texts, plain, file_values):
    rows = simple8b.token_files(documents, file_values=file_values).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == sorted(texts)
    start = 0
    for row in rows:
        ids = ids_of(plain, texts[row.doc_id])
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)


def test_odd_token_files(odd, odd_rows, empty, plain):
    rows = simple8b.token_files(odd).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i))
    expected = Counter((i, tuple(ids_of(plain, t))) for i, t in odd_rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == expected
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:n]) for n in range(len(rows))]
    assert simple8b.token_files(empty).count() == 0


def test_piece_lengths():
    assert powers.piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]
    assert powers.piece_lengths(1) == [1]
    for n in range(1, 5000, 7):
        assert sum(powers.piece_lengths(n)) == n
    with pytest.raises(ValueError):
        powers.pack(None, longest=100)


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_packing(documents, texts, odd, odd_rows, plain, monkeypatch, broadcast):
    monkeypatch.setattr(powers, "BROADCAST_ROWS", broadcast)
    for df, pairs in ((documents, list(texts.items())), (odd, odd_rows)):
        rows = powers.pack(df).collect()
        expected = Counter()
        for doc, text in pairs:
            ids = ids_of(plain, text)
            start = 0
            for n in powers.piece_lengths(len(ids)):
                expected[doc, start, n, len(ids), tuple(ids[start : start + n])] += 1
                start += n
        found = Counter(
            (r.doc_id, r.start, r.length, r.doc_tokens, tuple(np.frombuffer(r.ids, "<u4").tolist()))
            for r in rows
        )
        assert found == expected
        assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
        assert {r.offset for r in rows} == {0}
        order = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
        assert order == sorted(order, reverse=True)


def test_packing_nothing(empty):
    assert powers.pack(empty).count() == 0


def test_queries(spark, texts, plain):
    from crawltable.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = queries.op4_simple8b(spark, sf).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert {r.doc_id: r.ids_crc32 for r in rows} == {i: crc(ids_of(plain, t)) for i, t in texts.items()}
    pieces = defaultdict(dict)
    for r in queries.op5_packing(spark, sf).collect():
        pieces[r.doc_id][r.start] = (r.length, r.ids_crc32)
    for doc, text in texts.items():
        ids = ids_of(plain, text)
        assert {s: crc(ids[s : s + n]) for s, (n, _) in pieces[doc].items()} == {
            s: c for s, (_, c) in pieces[doc].items()
        }
        assert sum(n for n, _ in pieces[doc].values()) == len(ids)
