"""Personal data, and terms that disclose it, by information content.

Base spans (addresses, cards, phones) come from patterns with checks. Each value found
is a protected entity. The corpus tells how strongly a term of the lines around it gives
an entity away: with N lines, n(e) lines holding the entity, n(t) holding the term and
n(t,e) holding both, the disclosure is the pointwise mutual information over the
information content of the entity,

    log(N n(t,e) / (n(t) n(e))) / log(N / n(e)),

1 if the term implies the entity and 0 if they are independent. A term that meets an
entity in ``min_contexts`` different lines (copies of a line count once there) and
discloses it by ``generalise`` or more becomes a span wherever it stands, in texts
without the entity as well, which it would give away there; from ``remove`` on it is taken
out of the sanitised text, below that replaced by a general word.

All counts are over all lines. Only terms that may qualify are counted corpus-wide; a
bitmap of fixed size preselects them in the scan, the exact terms come from a join. The
texts that hold a disclosing term are found in the same way.
Null texts are empty. Repeated rows and null ids keep a row each. Other columns are not
read by ``find_private`` and are kept by ``sanitise``.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawltable.llm.arrow import free_name, slices
from crawltable.workspace import scratch, stage

MIN_CONTEXTS = 3
GENERALISE = 0.8
REMOVE = 0.95
MIN_TERM_CHARS = 4
BITMAP_BITS = 1 << 22

KINDS = ("email", "ip", "card", "phone", "term")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]+")
_FOUR = re.compile(r"[0-9]+\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(rf"[^\W\d_]{{{MIN_TERM_CHARS},}}")

Span = tuple[int, int, int]  # start, kind, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; every match has one @, so each @ is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """A run of digits that starts no match has none inside either."""
    place = 0
    while run := _DIGITS.search(text, place):
        place = run.end()
        found = _FOUR.match(text, run.start())
        if found:
            place = found.end()
            parts = found.group().split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
                yield found.span()


def _luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _GROUPED.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 10 <= sum(map(len, _DIGITS.findall(found.group()))) <= 15:
            yield found.span()


def base_spans(text: str) -> list[Span]:
    spans = []
    if "@" in text:
        spans += [(s, 0, e) for s, e in _emails(text)]
    if _DIGITS.search(text):
        spans += [(s, 1, e) for s, e in _addresses(text)]
        spans += [(s, 2, e) for s, e in _cards(text)]
        if "+" in text:
            spans += [(s, 3, e) for s, e in _phones(text)]
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _entity(text: str, span: Span) -> str:
    start, kind, end = span
    value = text[start:end].lower()
    return f"{KINDS[kind]}:{value if kind < 2 else re.sub('[^0-9]', '', value)}"


def _terms(text: str) -> set[str]:
    return {t.lower() for t in _TERM.findall(text)}


def _term_hash(term: str) -> int:
    return int.from_bytes(hashlib.blake2b(term.encode(), digest_size=8).digest(), "little", signed=True)


MEETINGS = "entity string, context bigint, terms array<string>, n_lines bigint"


def _meetings(df: DataFrame, text: str) -> DataFrame:
    """A row for each entity and line with the line's terms, and rows that count lines."""
    source = df.select(F.col(f"`{text}`")).where(F.col(f"`{text}`").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("entity", pa.string()), ("context", pa.int64()),
            ("terms", pa.list_(pa.string())), ("n_lines", pa.int64()),
        ])
        for part in _sliced(batches, 0):
            lines, out = 0, []
            for whole in part.column(0).to_pylist():
                lines += whole.count("\n") + 1
                spans = base_spans(whole)
                if not spans:
                    continue
                for entities, rest in _by_line(whole, spans):
                    context = _term_hash(" ".join(rest.split()))
                    terms = sorted(_terms(rest))
                    out += [(entity, context, terms, None) for entity in entities]
            out.append((None, None, None, lines))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
            )

    return source.mapInArrow(run, MEETINGS)


def _sliced(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut by the size of their texts, column ``text``."""
    for batch in batches:
        for start, length in slices(batch.column(text)):
            yield batch.slice(start, length)


def _by_line(text: str, spans: list[Span]) -> Iterator[tuple[set[str], str]]:
    """Entities of each line that has some, and the line without them."""
    n = 0
    while n < len(spans):
        start = text.rfind("\n", 0, spans[n][0]) + 1
        end = text.find("\n", spans[n][0])
        end = len(text) if end < 0 else end
        entities, pieces, place = set(), [], start
        while n < len(spans) and spans[n][0] < end:
            entities.add(_entity(text, spans[n]))
            pieces.append(text[place : max(place, spans[n][0])])
            place = max(place, spans[n][2])
            n += 1
        pieces.append(text[place:end])
        yield entities, " ".join(pieces)


def disclosing_terms(
    df: DataFrame,
    text: str = "text",
    min_contexts: int = MIN_CONTEXTS,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """``text_hash`` (xxhash64 of a text) and the ``terms`` to generalise and to
    ``removed``, for each text that holds a term that discloses some entity. Staged."""
    spark = df.sparkSession
    with scratch(spark, "disclosure") as folder:
        met = stage(_meetings(df, text), "met", folder)
        entities = met.where("entity IS NOT NULL")
        n_lines = met.agg(F.sum("n_lines")).first()[0] or 0
        pairs = entities.select("entity", "context", F.explode("terms").alias("term"))
        pairs = pairs.groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
        pairs = pairs.groupBy("entity", "term").agg(
            F.count("*").alias("contexts"), F.sum("n").alias("n_both")
        )
        pairs = stage(pairs.where(F.col("contexts") >= min_contexts), "pairs", folder)
        counts = _term_counts(df, text, pairs.select("term").distinct(), folder)
        shown = entities.groupBy("entity").agg(F.count("*").alias("n_entity"))
        scored = pairs.join(counts, "term").join(shown, "entity")
        total = F.lit(float(n_lines))
        content = F.log(total / F.col("n_entity"))
        mutual = F.log(total * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
        scored = scored.withColumn("disclosure", F.when(content > 0, mutual / content))
        scored = scored.where(F.col("disclosure") >= generalise).groupBy("term")
        scored = stage(scored.agg(F.max("disclosure").alias("disclosure")), "scored", folder)
        found = _holders(df, text, scored, folder).join(scored, "term")
        gone = F.col("disclosure") >= remove
        found = found.groupBy("text_hash").agg(
            F.collect_list(F.when(~gone, F.col("term"))).alias("terms"),
            F.collect_list(F.when(gone, F.col("term"))).alias("removed"),
        )
        return stage(found, "disclosing")


def _bitmap(terms: DataFrame, label: str, folder: str) -> tuple[DataFrame, np.ndarray]:
    """``term`` and its ``hash``, staged, and which hashes there are, modulo BITMAP_BITS."""
    hashed = terms.mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_term_hash(t) for t in b.column(0).to_pylist()], pa.int64())],
                names=["term", "hash"],
            )
            for b in batches
        ),
        "term string, hash bigint",
    )
    hashed = stage(hashed, label, folder)
    # At most BITMAP_BITS numbers reach the driver, whatever the number of terms is.
    places = hashed.select(F.pmod("hash", F.lit(BITMAP_BITS)).cast("int").alias("place")).distinct()
    bitmap = np.zeros(BITMAP_BITS, bool)
    bitmap[places.toArrow().column(0).to_numpy()] = True
    return hashed, bitmap


def _holders(df: DataFrame, text: str, terms: DataFrame, folder: str) -> DataFrame:
    """``text_hash`` and ``term`` for the distinct texts that hold some of ``terms``."""
    spark = df.sparkSession
    hashed, bitmap = _bitmap(terms.select("term"), "disclosing_terms", folder)
    if not bitmap.any():
        return hashed.select(F.col("hash").alias("text_hash"), "term")
    wanted = spark.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted.value).astype(bool)
        known: dict[str, bool] = {}
        for batch in batches:
            for start, length in slices(batch.column(0)):
                keys, held = [], []
                some = batch.slice(start, length)
                for whole, key in zip(*(c.to_pylist() for c in some.columns)):
                    for term in _terms(whole):
                        if term not in known:
                            if len(known) > 1_000_000:
                                known.clear()
                            known[term] = bool(bits[_term_hash(term) % BITMAP_BITS])
                        if known[term]:
                            keys.append(key)
                            held.append(term)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(held, pa.string())], names=["text_hash", "term"]
                )

    source = df.select(F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`")).where("text IS NOT NULL")
    met = source.mapInArrow(run, "text_hash bigint, term string")
    return met.join(hashed.select("term"), "term", "left_semi").distinct()


def _term_counts(df: DataFrame, text: str, terms: DataFrame, folder: str) -> DataFrame:
    """``n_term``, the number of lines that hold each of ``terms``."""
    spark = df.sparkSession
    hashed, bitmap = _bitmap(terms, "terms", folder)
    wanted = spark.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted.value).astype(bool)
        known: dict[str, int | None] = {}
        for batch in batches:
            counts: dict[int, int] = {}
            for start, length in slices(batch.column(0)):
                for whole in batch.column(0).slice(start, length).to_pylist():
                    for line in whole.split("\n"):
                        for term in _terms(line):
                            if term not in known:
                                if len(known) > 1_000_000:
                                    known.clear()
                                value = _term_hash(term)
                                known[term] = value if bits[value % BITMAP_BITS] else None
                            value = known[term]
                            if value is not None:
                                counts[value] = counts.get(value, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                names=["hash", "n"],
            )

    if not bitmap.any():
        return hashed.select("term", F.lit(0).cast("bigint").alias("n_term"))
    source = df.select(F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    counted = source.mapInArrow(run, "hash bigint, n bigint")
    counted = counted.groupBy("hash").agg(F.sum("n").alias("n_term"))
    return hashed.join(counted, "hash").select("term", "n_term")


def all_spans(text: str, terms: set[str]) -> list[Span]:
    """Base spans, and the terms outside them."""
    spans = base_spans(text)
    if not terms:
        return spans
    added = []
    for found in _TERM.finditer(text):
        inside = any(s < found.end() and found.start() < e for s, _, e in spans)
        if found.group().lower() in terms and not inside:
            added.append((found.start(), 4, found.end()))
    return sorted(spans + added)


def sanitised(text: str, spans: list[Span], removed: set[str]) -> str:
    """The text with spans replaced; overlapping ones become one, named by the first."""
    out, place = [], 0
    for start, kind, end in spans:
        if start >= place:
            out.append(text[place:start])
            gone = KINDS[kind] == "term" and text[start:end].lower() in removed
            out.append("" if gone else f"[{KINDS[kind].upper()}]")
        place = max(place, end)
    return "".join([*out, text[place:]])


def _with_terms(df: DataFrame, text: str, disclosing: DataFrame) -> DataFrame:
    """``df`` with two more columns at its end, the terms of its texts."""
    names = [free_name(df, n) for n in ("text_hash", "terms", "removed")]
    keyed = disclosing.select("text_hash", "terms", "removed").toDF(*names)
    joined = df.join(keyed, F.xxhash64(f"`{text}`") == F.col(names[0]), "left")
    return joined.drop(names[0])


PRIVATE = """n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string,
  spans string, n_terms bigint"""


def find_private(
    df: DataFrame, id: str = "doc_id", text: str = "text", disclosing: DataFrame | None = None
) -> DataFrame:
    """All spans of each text, and the counts and a digest of the base ones."""
    disclosing = disclosing_terms(df, text) if disclosing is None else disclosing
    source = df.select(F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    source = _with_terms(source, "text", disclosing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _sliced(batches, 1):
            out = [[] for _ in range(8)]
            for doc, whole, terms, removed in zip(*(c.to_pylist() for c in part.columns)):
                spans = all_spans(whole or "", {*(terms or ()), *(removed or ())})
                base = [s for s in spans if s[1] < 4]
                kinds = [sum(s[1] == k for s in spans) for k in range(5)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                for column, value in zip(out, (doc, *kinds[:4], digest, written(spans), kinds[4])):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_terms"],
            )

    return source.mapInArrow(run, "doc_id bigint, " + PRIVATE)


def sanitise(df: DataFrame, text: str = "text", disclosing: DataFrame | None = None) -> DataFrame:
    """``df`` with sanitised texts; null texts stay null."""
    disclosing = disclosing_terms(df, text) if disclosing is None else disclosing
    names, place = df.columns, df.columns.index(text)
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, place):
            clean = []
            columns = (batch.column(k).to_pylist() for k in (place, n, n + 1))
            for whole, terms, removed in zip(*columns):
                if whole is not None:
                    gone = set(removed or ())
                    whole = sanitised(whole, all_spans(whole, gone | set(terms or ())), gone)
                clean.append(whole)
            kept = list(batch.columns[:n])
            kept[place] = pa.array(clean, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(kept, names=names)

    return _with_terms(df, text, disclosing).mapInArrow(run, df.schema)
