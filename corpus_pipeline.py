"""From raw documents to packed training windows, in stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.llm import decontam, jaccard, langid, packing, privacy
from slotviews.llm.common import stored, table, unused
from slotviews.llm.queries import tokenizer_path


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language can be told; see ``langid.predict``.

    Where no row has a language to learn from, all documents stay.
    """
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs
    said = langid.predict(docs.select(F.struct("*").alias("row"), F.col("text")), model)
    return said.filter("NOT ambiguous").select("row.*")


def marked(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Joins ``marks`` with documents of the same ``doc_id`` and ``text_hash``; no column clashes."""
    names = {c: unused(docs, f"mark_{c}") for c in marks.columns}
    marks = marks.withColumnsRenamed(names)
    same = docs["doc_id"].eqNullSafe(marks[names["doc_id"]]) & (F.xxhash64(docs["text"]) == marks[names["text_hash"]])
    return docs.join(marks, same, how)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that links connect: the smallest id, then text hash.

    Rows that repeat throughout count once; rows without an id go to any other of their group.
    """
    first = jaccard.linked_components(docs).filter("first").select("doc_id", "text_hash").distinct()
    return marked(docs, first, "left_semi").dropDuplicates()


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    hits = decontam.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), short_items=True)
    return marked(docs, hits.select("doc_id", "text_hash").distinct(), "left_anti")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts."""
    found = privacy.personal_spans(docs).filter(F.size("spans") > 0).select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"])
    spans = F.col(unused(docs, "mark_spans"))
    text = F.when(spans.isNull(), F.col("text")).otherwise(privacy.masked(F.col("text"), spans))
    rows = marked(docs, found, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into windows of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", languages),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private data", private_data),
    ("packing", windows),
]

#: models, fingerprints and tokenizers are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
