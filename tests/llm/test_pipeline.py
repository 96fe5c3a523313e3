import os
import re
import shutil
import subprocess
import sys

import numpy as np
import pytest
from helpers import SMALL, documents, odd_texts, table_rows
from pyspark.sql import functions as F
from test_jaccard import expected as grouped
from test_privacy import PLAIN, valid

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage returns on the smallest tables, each made from the one before."""
    import corpus_pipeline

    from slotviews.llm.common import stored, table

    docs, out = table(spark, SMALL, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "test-stage")
        out.append(docs)
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "decontamination", "private data", "packing"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_language_keeps_documents_with_a_language(stages):
    lettered = {i for i, t in table_rows("documents", "doc_id, text") if t and any(c.isalpha() for c in t)}
    assert set(by_id(stages[0])) <= lettered and len(by_id(stages[0])) >= 0.99 * len(lettered)


def test_one_document_of_each_group_stays(stages):
    before = by_id(stages[0])
    ids = sorted(before)
    groups = grouped(ids, [before[i].text for i in ids])
    assert set(by_id(stages[1])) == {component for _, component in groups.values()}


def test_benchmark_passages_go_and_clean_documents_stay(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    items = [t for _, t in table_rows("benchmark", "item_id, text")]
    dirty = {i for i, r in before.items() if any(t in r.text for t in items)}
    assert dirty and set(after) == set(before) - dirty


def test_private_data_is_masked(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    assert set(before) == set(after)
    for i, row in after.items():
        found = [m for kind, p in PLAIN.items() for m in re.finditer(p, before[i].text) if valid(kind, m.group())]
        assert not [m for kind, p in PLAIN.items() for m in re.finditer(p, row.text) if valid(kind, m.group())]
        assert (row.text != before[i].text) == bool(found) and row.n_chars == len(row.text)


def test_packing_holds_every_text(stages):
    from tokenizers import Tokenizer

    from slotviews.llm.queries import tokenizer_path

    tokenizer, rows = Tokenizer.from_file(tokenizer_path()), stages[4].collect()
    for i, row in by_id(stages[3]).items():
        pieces = sorted((r.start, np.frombuffer(r.ids, "<u4")) for r in rows if r.doc_id == i)
        assert np.concatenate([p for _, p in pieces]).tolist() == tokenizer.encode(row.text).ids + [1]


def test_run_is_the_chain(spark, stages):
    import corpus_pipeline

    key = lambda df: sorted((r.doc_id, r.start, r.length, bytes(r.ids)) for r in df.collect())
    whole = lambda rows: {i: b"".join(x[3] for x in rows if x[0] == i) for i in {x[0] for x in rows}}
    assert whole(key(corpus_pipeline.run(spark, SMALL))) == whole(key(stages[4]))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_odd_documents(spark):
    import corpus_pipeline

    from slotviews.llm.common import stored

    for texts, ids in ((odd_texts(), None), ([], None), (["some words here", "some words here", None], [None, None, 3])):
        docs = documents(spark, texts, ids)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stored(stage(spark, docs, SMALL), "odd-stage")
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()


def test_columns_of_any_name_pass(spark):
    import corpus_pipeline

    texts = [t or "" for t in odd_texts()[3:9]] + ["mail me@ex.org please, my good friend"]
    names = ["_id", "_h", "_spans", "_said", "said", "row", "mark_doc_id", "mark_text_hash", "mark_spans", "first", "hash", "class", "Mark_Spans_", "a.b"]
    docs = documents(spark, texts).selectExpr("doc_id", "text", "lang", "n_chars", *[f"{i} AS `{name}`" for i, name in enumerate(names)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
    rows = docs.collect()
    assert rows and all(tuple(r)[4:] == tuple(range(len(names))) for r in rows)
    assert any(r.text.startswith("mail [EMAIL]") for r in rows)


def test_documents_pass_where_no_language_is_known(spark):
    import corpus_pipeline

    docs = documents(spark, ["some words", "123", None]).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.languages(spark, docs, SMALL).count() == 3


def test_one_of_two_near_copies_under_one_id_stays(spark):
    import corpus_pipeline

    base = " ".join(f"word{i}" for i in range(80))
    docs = documents(spark, [base, base + " end", base + " other end", "something else altogether here now"], [4, 4, None, 4])
    rows = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    assert len(rows) == 2 and {r.doc_id for r in rows} == {4} and "something else altogether here now" in {r.text for r in rows}


def test_the_rest_works_without_this_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and not [n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline']; assert e.entry and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})
