import hashlib
import re
import time

from helpers import documents, odd_texts, table_rows
from pyspark.sql import functions as F

from slotviews.llm import privacy

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(x - 9 if x > 9 else x for x in twice)) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def expected(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if valid(kind, m.group())]
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))


TRICKY = [
    "a@b.c_d@e.f x@y@z.w a@b a.b@c-d.e.f, <q+r%s@t.uu>", "1.2.3.4 256.1.1.1 001.02.3.255 1.2.3.4.5.6.7.8 9.9.9", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 5 5",
    "+1 (555) 123-4567 +49.30.123456 ++12 345 678 901 +1 2", "é🙂漢 me@é.de me@ex.org +44 20 7946 0958", "4785380592391139$$$ 152.143.123.131###", "0" * 30_000, "1 " * 30_000, "a" * 30_000 + "@", ".".join("1" * 9000), "@" * 3000, "+" + "1 " * 20_000,
    " ".join(f"u{i}@h{i}.org" for i in range(3000)),
]


def test_base_spans(spark):
    texts = odd_texts() + TRICKY + [t for _, t in table_rows("documents", "doc_id, text")]
    rows = privacy.personal_spans(documents(spark, texts)).select("doc_id", privacy.listed(F.col("base")).alias("s")).collect()
    got = {r.doc_id: r.s for r in rows}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == expected(text), (text or "")[:60]


def test_contexts_find_more(spark):
    texts = [f"Please call the hotline number +49 30 1234{i:04d} today, order {i}." for i in range(40)]
    texts += ["Please call the hotline number 030-555-0199-12 today.", "the hotline number twelve", "the hotline number 42", "an unrelated number 030-555-0199-12 here"]
    rows = {r.doc_id: r for r in privacy.personal_spans(documents(spark, texts)).select("doc_id", privacy.listed(F.col("base")).alias("b"), privacy.listed(F.col("spans")).alias("s")).collect()}
    start = texts[40].index("030")
    assert rows[40].b == "" and rows[40].s == f"phone:{start}:{start + 15}"
    assert rows[41].s == rows[42].s == ""
    assert all(rows[i].s == rows[i].b != "" for i in range(40))


def test_mentions_in_a_row_have_contexts(spark):
    texts = ["accounts 123456789, 987654321, 456789123 and 5", "| name | 11 | 22 |\n| 33 | | 44 |", "see 1\n2\n\n3", "9 first", "call me 7 or 8", "tel +49 30 123456789 then 6", "a " + "w" * 90 + " 4", None, ""]
    rows = documents(spark, texts).select("doc_id", privacy._mentions(F.coalesce("text", F.lit("")), privacy.base_spans(F.coalesce("text", F.lit("")))).alias("m")).collect()
    got = {r.doc_id: [(m.value, m.pattern) for m in r.m or ()] for r in rows}
    assert got[0] == [("123456789", " accounts"), ("987654321", "accounts <id>"), ("456789123", "<id> <id>"), ("5", "<id> and")]
    assert got[1] == [("11", "name "), ("22", "<id> "), ("33", "| |"), ("44", "| |")]
    assert got[2] == [("1", " see"), ("2", "see <id>"), ("3", "<id> <id>")]
    assert got[3] == [("9", "<start>")] and got[4] == [("7", "call me"), ("8", "<id> or")]
    assert got[5] == [("+49 30 123456789", " tel"), ("6", "<id> then")]
    assert got[6] == [("4", "a " + hashlib.sha256(b"w" * 90).hexdigest())]
    assert got[7] == got[8] == []


def test_a_list_of_unseen_identifiers_is_found(spark):
    texts = [f"our lines: +49 30 1234{i:04d}, +49 40 1234{i:04d}, +49 50 1234{i:04d}" for i in range(40)]
    texts += ["our lines: 030-555-0199-12, 040-555-0199-13, 050-555-0199-14"]
    rows = {r.doc_id: r.s for r in privacy.personal_spans(documents(spark, texts)).select("doc_id", privacy.listed(F.col("spans")).alias("s")).collect()}
    want = [f"phone:{m.start()}:{m.end()}" for m in re.finditer(r"0[0-9-]+", texts[40])]
    assert rows[40] == ",".join(want) and len(want) == 3


def test_masking(spark):
    texts = ["mail me@ex.org or +44 20 7946 0958.", "nothing", None, "", "🙂 1.2.3.4"]
    docs = documents(spark, texts)
    spans = privacy.personal_spans(docs).select(F.col("doc_id").alias("i"), "spans")
    rows = docs.join(spans, F.col("i") == F.col("doc_id")).select("doc_id", privacy.masked(F.col("text"), F.col("spans")).alias("m")).collect()
    assert {r.doc_id: r.m for r in rows} == {0: "mail [EMAIL] or [PHONE].", 1: "nothing", 2: None, 3: "", 4: "🙂 [IP]"}


def test_overlapping_spans_are_one_mask(spark):
    df = spark.sql("SELECT 'abcdefghij' AS text, array(named_struct('start', 1L, 'kind_no', 0, 'end', 5L, 'kind', 'email'), named_struct('start', 3L, 'kind_no', 1, 'end', 4L, 'kind', 'ip'), named_struct('start', 6L, 'kind_no', 2, 'end', 8L, 'kind', 'card')) AS spans")
    assert df.select(privacy.masked(F.col("text"), F.col("spans"))).first()[0] == "a[EMAIL]f[CARD]ij"


def test_repeated_rows_missing_ids_and_empty_table(spark):
    text = "a@b.cc"
    rows = privacy.personal_spans(documents(spark, [text, text, text, None], [1, 1, None, None])).collect()
    assert sorted((r.doc_id or -1, len(r.spans)) for r in rows) == [(-1, 0), (-1, 1), (1, 1), (1, 1)]
    assert privacy.personal_spans(documents(spark, [])).count() == 0


def test_a_text_of_many_spans_takes_time_in_proportion(spark):
    lines = [f"mail user{i}@host{i % 900}.org or call +49 30 {10_000_000 + i}, 🙂 ref {i}\n" for i in range(20_000)]
    docs = documents(spark, ["".join(lines)]).coalesce(1)
    started = time.time()
    row = privacy.personal_spans(docs).select("spans", "base").first()
    assert sum(s.kind != "card" for s in row.base) == 40_000 and time.time() - started < 90
    spans = privacy.personal_spans(docs).select(F.col("doc_id").alias("i"), "spans")
    text = docs.join(spans, F.col("i") == F.col("doc_id")).select(privacy.masked(F.col("text"), F.col("spans")).alias("m")).first().m
    assert text.startswith("mail [EMAIL] or call [PHONE], 🙂 ref ") and text.count("[EMAIL]") == text.count("[PHONE]") == 20_000


def test_spans_are_found_across_groups(spark):
    spans = [(i * 10, 0, i * 10 + 5 + 30 * (i % 97 == 0), "email") for i in range(600)]
    rows = [(s, e) for s in range(0, 6100, 7) for e in (s + 1, s + 12)]
    schema = "spans array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>, at array<struct<s:bigint,e:bigint>>"
    df = spark.createDataFrame([(spans, rows)], schema)
    got = df.select(F.transform("at", lambda m: privacy._overlapping(privacy._grouped(F.col("spans")), m["s"], m["e"])["start"])).first()[0]
    assert got == [next((a for a, _, b, _ in spans if a < e and b > s), None) for s, e in rows]


def test_no_python_runs(spark):
    started = time.time()
    df = privacy.personal_spans(documents(spark, ["a@b.cc"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and time.time() - started < 120
