"""Personal data against the patterns themselves, disclosure against plain counting."""

import hashlib
import math
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawltable.llm import disclosure
from crawltable.llm.disclosure import base_spans, disclosing_terms, find_private, sanitise, written

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(d) * (1 + n % 2) for n, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def good(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return (
        kind == 0
        or kind == 1 and all(int(p) <= 255 for p in found.split("."))
        or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits)
        or kind == 3 and 10 <= len(digits) <= 15
    )


def plain_spans(text):
    return sorted(
        (m.start(), kind, m.end())
        for kind, pattern in enumerate(PATTERNS)
        for m in re.finditer(pattern, text)
        if good(kind, m.group())
    )


@settings(max_examples=500)
@given(st.text(alphabet="01239.@+-() aZ%_\n", max_size=60))
def test_spans_are_those_of_the_patterns(text):
    assert base_spans(text) == plain_spans(text)


def test_long_runs_take_no_time():
    for part in ("1", "1.", "a", "a.", "@", "a@", "+", "+1", "1 ", "1-", "(1"):
        base_spans(part * 100_000)
    assert base_spans("1" * 5000 + ".1.1.1") == []


def row_of(text):
    spans = plain_spans(text or "")
    return [sum(s[1] == k for s in spans) for k in range(4)] + [
        hashlib.sha256(",".join(f"{disclosure.KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
    ]


def check(rows, pairs):
    found = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows)
    assert found == Counter((i, *row_of(t)) for i, t in pairs)


def test_documents(documents, texts, odd, odd_rows, empty):
    check(find_private(documents).collect(), texts.items())
    check(find_private(odd).collect(), odd_rows)
    assert find_private(empty).count() == 0
    clean = sanitise(odd)
    assert clean.columns == odd.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(odd_rows)
    assert sanitise(empty).count() == 0


HOLDERS = ("alpha beta", "gamma delta", "kappa lambda", "omega sigma", "alpha sigma")


def corpus():
    """ann@x.org always meets Rumpel, seldom elsewhere; bob@y.org meets common words."""
    texts = [f"write to ann@x.org says Rumpel near {words} today" for words in HOLDERS]
    texts += [f"ask bob@y.org about common things like {words} now" for words in HOLDERS]
    texts += ["common things about nothing much", "Rumpel alone"] * 4
    texts += [f"line {n} of the rest about common things\nand another line" for n in range(60)]
    texts += [texts[0]] * 5 + ["one rare hapax with eve@z.org"] + ["copied context with dan@q.org here"] * 9
    return list(enumerate(texts)) + [(None, None), (900, "")]


def plain_disclosure(pairs):
    """Entity to its terms and their disclosure, by counting lines."""
    lines, holding, having, both, contexts = 0, Counter(), Counter(), Counter(), defaultdict(set)
    for _, text in pairs:
        for line in [] if text is None else text.split("\n"):
            lines += 1
            spans = plain_spans(line)
            rest = line
            for start, _, end in reversed(spans):
                rest = rest[:start] + " " + rest[end:]
            having.update({t.lower() for t in re.findall(r"[^\W\d_]{4,}", line)})
            terms = {t.lower() for t in re.findall(r"[^\W\d_]{4,}", rest)}
            for entity in {line[s:e].lower() for s, _, e in spans}:
                holding[entity] += 1
                for term in terms:
                    both[entity, term] += 1
                    contexts[entity, term].add(" ".join(rest.split()))
    scores = {}
    for (entity, term), n in both.items():
        if len(contexts[entity, term]) >= 3:
            mutual = math.log(lines * n / (having[term] * holding[entity]))
            scores[entity, term] = mutual / math.log(lines / holding[entity])
    return scores


def test_disclosure(spark):
    pairs = corpus()
    df = spark.createDataFrame(pairs, "doc_id bigint, text string").withColumn("terms", F.lit(None).cast("int"))
    scores = plain_disclosure(pairs)
    assert scores["ann@x.org", "rumpel"] > 0.8 > scores["bob@y.org", "common"]
    held = {term for (_, term), v in scores.items() if v >= 0.8}
    found = {r.spans for r in find_private(df).collect()}
    expected = set()
    for _, text in pairs:
        spans = plain_spans(text or "")
        spans += [
            (m.start(), 4, m.end())
            for m in re.finditer(r"[^\W\d_]{4,}", text or "")
            if m.group().lower() in held and not any(s < m.end() and m.start() < e for s, _, e in spans)
        ]
        expected.add(written(sorted(spans)))
    assert found == expected
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert "Rumpel" not in clean[0] and "[EMAIL]" in clean[0] and "ann@" not in clean[0]
    assert clean[5].startswith("ask [EMAIL] about common things")
    # The term gives the address away, so it goes from texts without the address as well.
    gone = max(v for (_, term), v in scores.items() if term == "rumpel") >= disclosure.REMOVE
    assert clean[11] == (" alone" if gone else "[TERM] alone") and clean[None] is None
    assert disclosing_terms(df).count() > 0


def test_overlapping_spans_become_one():
    text = "call +1 (425) 555-0735 or 10.0.0.1 now"
    assert disclosure.sanitised(text, base_spans(text), set()) == "call [PHONE] or [IP] now"
    assert disclosure.sanitised("abcdef", [(0, 0, 4), (2, 1, 6)], set()) == "[EMAIL]"


def test_terms_are_masked_in_texts_without_the_entity(spark):
    """Half of the lines with Rumpel have the address, whose disclosure is over 0.8."""
    pairs = [(n, f"write to ann@x.org says Rumpel near {words} today") for n, words in enumerate(HOLDERS)]
    pairs += [(10 + n, f"{words} and Rumpel,\nwithout the address") for n, words in enumerate(HOLDERS)]
    pairs += [(100 + n, f"line {n} of the rest\nand Rumpelt") for n in range(5000)] + [(None, None)]
    df = spark.createDataFrame(pairs * 2, "doc_id bigint, text string")
    score = plain_disclosure(pairs * 2)["ann@x.org", "rumpel"]
    assert disclosure.GENERALISE <= score < disclosure.REMOVE
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert clean[12] == "kappa lambda and [TERM],\nwithout the address"
    assert clean[100] == "line 0 of the rest\nand Rumpelt"
    spans = {r.doc_id: (r.n_terms, r.spans) for r in find_private(df).collect()}
    assert spans[12] == (1, "term:17:23") and spans[100] == (0, "") and spans[None] == (0, "")
