"""The stages one after the other against plain versions of the operators."""

import ast
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from crawltable.llm import powers
from crawltable.llm.tokens import vocabulary_path
from crawltable.workspace import stage

from test_disclosure import plain_spans
from test_graysim import fingerprint, groups, near
from test_latent import plain
from test_repetition import counted, passes

SF_DIR = "/root/testdata/sf0.001"


def test_run(spark, texts):
    kept = {i: t for i, t in texts.items() if passes(counted(t))[1]}
    prints = {i: fingerprint(t) for i, t in kept.items()}
    roots = groups(set(prints.values()), near(prints.values()))
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    kept = {i: t for i, t in kept.items() if i in least.values()}
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not any(plain(q) in plain(t) for q in items)}
    names = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
    for i, text in kept.items():
        out, place = "", 0
        for start, kind, end in plain_spans(text):
            if start >= place:
                out += text[place:start] + names[kind]
            place = max(place, end)
        kept[i] = out + text[place:]
    tokens = Tokenizer.from_file(vocabulary_path())
    expected = Counter()
    for i, text in kept.items():
        ids = [*tokens.encode(text, add_special_tokens=False).ids, 1]
        start = 0
        for n in powers.piece_lengths(len(ids)):
            expected[i, start, tuple(ids[start : start + n])] += 1
            start += n
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == expected


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd_rows):
    rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in odd_rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for n, (_, apply) in enumerate(corpus_pipeline.STAGES[:-1]):
            docs = stage(apply(spark, docs, SF_DIR), f"odd-{n}")
            assert docs.dtypes == spark.createDataFrame([], schema).dtypes
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
        assert (packed.count() > 0) == bool(some)


def test_the_library_does_without_the_subpackage(tmp_path):
    """Nothing outside llm imports it but the entry, which checks."""
    root = Path(corpus_pipeline.__file__).parent
    for file in (root / "crawltable").rglob("*.py"):
        if "llm" in file.parts:
            continue
        for node in ast.walk(ast.parse(file.read_text())):
            if isinstance(node, (ast.Import, ast.ImportFrom)):
                assert "llm" not in ast.unparse(node)
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "crawltable.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert not any(n.startswith("op") or n == "pipeline" for n in e.queries()), list(e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
