import hashlib
import random

from helpers import documents, odd_texts, prose, table_rows
from pyspark.sql import functions as F

from slotviews.llm import fingerprints
from slotviews.llm.common import with_next


def edited(rows):
    """The contract's edited text and the next row, by hand."""
    rows = sorted(rows)
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out[doc] = text[: len(text) - half] + following[:half]
    return out


def test_edited_text_and_likeness(spark):
    rows = list(enumerate(odd_texts())) + [(100 + 3 * i, t) for i, t in table_rows("documents", "doc_id, text")[:60]]
    ids, texts = zip(*rows, strict=True)
    df = fingerprints.edited_and_next(documents(spark, texts, ids).repartition(4))
    fp = {n: fingerprints.as_text(F.col(n)) for n in ("fp", "edited_fp")}
    got = df.select("doc_id", "n_chars", F.sha2("edited", 256).alias("sha"), fp["fp"].alias("own"), fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("e"), fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("n")).collect()
    want, of = edited(rows), dict(rows)
    assert {r.doc_id: r.sha for r in got} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    assert all(r.n_chars == len(of[r.doc_id] or "") for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(of[r.doc_id], r.own) == r.own
        assert 0 <= r.e <= 1 and 0 <= r.n <= 1
    long = [r for r in got if r.doc_id >= 100 and r.n_chars > 600]
    assert sum(r.e > r.n for r in long) > 0.95 * len(long)


def with_fp(spark, texts):
    return fingerprints.add_fingerprint(documents(spark, texts), "text", "fp")


def test_order_insertion_and_deletion(spark):
    paragraphs = [prose(i, 30).replace("\n", " ") for i in range(8)]
    shuffled = list(paragraphs)
    random.Random(1).shuffle(shuffled)
    texts = ["\n".join(paragraphs), "\n\n".join(shuffled), "\n".join(paragraphs[:5]), "\n".join(paragraphs[5:]), "\n".join(paragraphs[:-1])]
    fps = with_fp(spark, texts).groupBy().pivot("doc_id", list(range(5))).agg(F.first("fp"))
    text = lambda c: fingerprints.as_text(c)
    row = fps.select(text(F.col("0")).alias("a"), text(F.col("1")).alias("b"), text(fingerprints.inserted(F.col("2"), F.col("3"))).alias("c"), text(fingerprints.deleted(F.col("0"), F.col("3"))).alias("d"), text(F.col("2")).alias("e"), text(F.col("4")).alias("f")).first()
    assert row.a == row.b == row.c and row.d == row.e and row.a != row.f


def test_likeness_follows_the_shared_part(spark):
    parts = [prose(i, 20).replace("\n", " ") + "." for i in range(60)]
    texts = ["\n".join(parts[:40]), "\n".join(parts[10:50]), "\n".join(parts[20:60]), "\n".join(parts[:40]), ""]
    df = with_fp(spark, texts).select("doc_id", "fp")
    one = df.filter("doc_id = 0").select(F.col("fp").alias("first"))
    got = {r.doc_id: r.x for r in df.crossJoin(one).select("doc_id", fingerprints.likeness(F.col("first"), F.col("fp")).alias("x")).collect()}
    assert got[0] == got[3] == 1 and abs(got[1] - 0.75) < 0.2 and abs(got[2] - 0.5) < 0.25 and got[4] < 0.3


def test_empty_and_single(spark):
    assert fingerprints.edited_and_next(documents(spark, [])).count() == 0
    row = fingerprints.edited_and_next(documents(spark, ["abcde"])).first()
    assert row.edited == "abcab" and row.fp == row.next_fp


def test_next_row_over_gaps_ties_and_nulls(spark):
    ids = [None, 5, 1, 10**12, 7, 7, -3, 10**6, 10**6 + 1]
    df = documents(spark, [str(i) for i in range(len(ids))], ids)
    for block in (1, 2, 1000):
        got = sorted((r.text, r.next_text) for r in with_next(df, "doc_id", ["text"], block).collect())
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i], str(i)))
        assert got == sorted((str(i), str(order[(k + 1) % len(order)])) for k, i in enumerate(order))
