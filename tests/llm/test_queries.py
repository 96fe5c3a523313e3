"""Every query over the smallest tables: against its SQL, or its contract in plain Python."""

import hashlib
import zlib

import numpy as np
import pytest
from checks.verify import collect, compare, database, oracle
from helpers import SMALL, table_rows

from slotviews.llm import queries

DOCUMENTS = dict(table_rows("documents", "doc_id, text"))


def test_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_agrees(spark, name):
    rows = collect(queries.queries()[name](spark, SMALL))
    assert len(rows) and compare(rows, oracle(database(SMALL), queries.oracle_sql()[name])) == ""


def test_fingerprints(spark):
    from test_fingerprints import edited

    rows, want = queries.op2_multiset_fingerprint(spark, SMALL).collect(), edited(list(DOCUMENTS.items()))
    assert rows[0].__fields__[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert {r.doc_id: r.edited_sha256 for r in rows} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert np.mean([r.near_edited for r in rows]) > 0.3 > np.mean([r.near_next for r in rows])


def test_personal_data(spark):
    from test_privacy import expected

    for r in queries.op6_bootstrapped_pii(spark, SMALL).collect():
        want = expected(DOCUMENTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k + ":") for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_suffixes(spark):
    from test_suffixes import expected

    want = {i: (kept, ranges) for i, ranges, kept in expected(list(DOCUMENTS.items()), 100)}
    for r in queries.op7_suffix_dedup(spark, SMALL).collect():
        kept, ranges = want.pop(r.doc_id)
        assert r.n_bytes == len((DOCUMENTS[r.doc_id] or "").encode())
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (r.n_bytes - len(kept), len(ranges), hashlib.sha256(kept).hexdigest())
    assert not want


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {i: np.array(tokenizer.encode(t or "").ids + [1], "<u4") for i, t in DOCUMENTS.items()}
    rows = queries.op9_sum_of_squares_packing(spark, SMALL).collect()
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    windows = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) / (2048 * windows) > 0.98


def test_archives(spark):
    from test_warc import expected, found

    assert found(queries.op10_warc_index(spark, SMALL)) == expected(table_rows("pages", "page_id, url, html"))
