"""Token ids of whole texts, each distinct word being tokenized once per task."""

import json
import os
import re
import unicodedata
from collections.abc import Sequence

import numpy as np

from crawltable.llm.chars import RollingHash, Texts, chunks, expand, kept_in_process

VOCABULARY = "word_bpe_49k.json"
END_ID = 1

# Distinct words remembered by a task before it starts afresh.
REMEMBERED_WORDS = 1_000_000

SPACE, LETTER, NUMBER, OTHER, UNSURE = range(5)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def character_classes() -> np.ndarray:
    """Class of each code point, for the tokenizer's division into words.

    UNSURE marks what libraries may treat differently: controls, marks, unassigned
    code points and the sigma whose lower case depends on its place.
    """
    classes = np.full(0x110000, UNSURE, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER, "P": OTHER, "S": OTHER, "Z": SPACE}
    for code in range(0x30000):
        kind = kinds.get(unicodedata.category(chr(code))[0])
        if kind is not None:
            classes[code] = kind
    classes[[0x09, 0x0A, 0x0D]] = SPACE
    classes[[0x03A3, 0x03C2, 0x03C3]] = UNSURE
    return classes


def tokenizer(path: str) -> "WordTokenizer":
    return kept_in_process(f"tokenizer {path}", lambda: WordTokenizer(path))


def byte_characters() -> list[str]:
    """The visible character that byte-level vocabularies write for each byte."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(0x100)]


# How the known vocabulary prepares a text and divides it into words.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
DIVISION = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


def divides_words(rules: dict) -> bool:
    """Whether a vocabulary file divides texts as ``plain`` and ``pieces`` do."""
    normalizer, division = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}
    steps = division.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and steps[0] == DIVISION
        and [step.get("type") for step in steps[1:]] == ["ByteLevel"]
        and not steps[1].get("add_prefix_space")
        and not steps[1].get("use_regex")
    )


class WordTokenizer:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    The vocabulary divides a text into runs of letters, single digits and runs of
    other characters and encodes each by itself, so the ids of a word can be reused.
    Texts with special tokens or with characters of unsure class go through the
    tokenizer as a whole, and so do all texts where the vocabulary divides them in
    another way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.divides = divides_words(json.load(file))
        special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.classes = character_classes()
        self.visible = byte_characters()
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        found = []
        texts = [text or "" for text in texts]
        for part in chunks(texts):
            if not self.divides:
                whole = self.whole.encode_batch(texts[part], add_special_tokens=False)
                found += [np.array(one.ids, np.uint32) for one in whole]
                continue
            found += self._encode_chunk(texts[part])
        return found

    def _encode_chunk(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED_WORDS:
            self._forget()
        laid = Texts([plain(text) for text in texts])
        classes = self.classes[laid.codes]
        odd = laid.count(classes == UNSURE) > 0
        odd |= np.fromiter((bool(self.special.search(text)) for text in texts), bool, len(texts))
        start, end = pieces(laid.codes, classes)
        hashes = RollingHash(laid.codes).spans(start, end)
        order = np.argsort(hashes)
        sorted_hashes = hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
        distinct, which = sorted_hashes[new], np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        self._learn(distinct, order[new], start, end, laid)
        word = np.searchsorted(self.known, distinct)[which]
        owner = laid.owner(start)
        sizes = self.sizes[word]
        sizes[odd[owner]] = 0
        ids = self.ids[expand(self.places[word], sizes)]
        lengths = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)
        parts = np.split(ids, np.cumsum(lengths)[:-1])
        for n in np.flatnonzero(odd):
            whole = self.whole.encode(texts[n], add_special_tokens=False).ids
            parts[n] = np.array(whole, np.uint32)
        return parts

    def _learn(self, distinct, first, start, end, laid) -> None:
        """Tokenize the words that are new; ``first`` holds an occurrence of each."""
        new = ~np.isin(distinct, self.known, assume_unique=True)
        first = first[new]
        if not len(first):
            return
        joined = "\n".join(laid.texts)
        ids, sizes = [], []
        tokenize, visible = self.whole.model.tokenize, self.visible.__getitem__
        for s, e in zip(start[first].tolist(), end[first].tolist()):
            word = joined[s:e]
            if not word.isascii() or not word.isprintable():
                word = "".join(map(visible, word.encode("utf-8", "replace")))
            tokens = tokenize(word)
            sizes.append(len(tokens))
            ids += [token.id for token in tokens]
        sizes = np.array(sizes, np.int64)
        places = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate((self.ids, np.array(ids, np.uint32)))
        order = np.argsort(known := np.concatenate((self.known, distinct[new])))
        self.known = known[order]
        self.places = np.concatenate((self.places, places))[order]
        self.sizes = np.concatenate((self.sizes, sizes))[order]


def plain(text: str) -> str:
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.lower()


def pieces(codes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the words: letters, one digit, other characters, contractions."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.ones(n, bool)
    starts[1:] = (classes[1:] != classes[:-1]) | (classes[1:] == NUMBER)
    marks = np.flatnonzero((codes == 0x27) & starts)
    if len(marks):
        padded = np.concatenate((codes, np.zeros(3, codes.dtype)))
        one, two = padded[marks + 1], padded[marks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        for chosen, size in ((short, 2), (long, 3)):
            at = marks[chosen]
            starts[at + 1] = False
            after = at + size
            after = after[after < n]
            starts[after] = True
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], n)
    keep = classes[begin] != SPACE
    return begin[keep], end[keep]
