"""Removal of repeated lines, paragraphs or sentences, keeping the first occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import running, stored

LINE = "\\n"
PARAGRAPH = "\\n(?:[ \\t\\r]*\\n)+"
#: parts of a line that a full stop, question or exclamation mark and a space end, with both
SENTENCE = "(?s).*?(?:\\n|[.!?] )|.+\\z"
_GLUE = {LINE: "\n", PARAGRAPH: "\n\n", SENTENCE: ""}


def normalised(unit: Column) -> Column:
    """Lower case, runs of characters that are no letter or digit as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(unit), "[^\\p{L}\\p{N}]+", " "))


def dedup_units(docs: DataFrame, separator: str = LINE, min_chars: int = 1, min_words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its kept text and the removed units with their offsets.

    A text is cut at ``separator`` (LINE or PARAGRAPH), or into sentences, which never cross
    a line and keep the space or line end behind them (SENTENCE). Units whose normal form
    has at least ``min_chars`` characters and ``min_words`` words, as shorter ones repeat by
    chance and are no passages, are grouped over all documents by a 256-bit digest. The
    occurrence with the smallest document id, then the smallest position, stays; all others
    go, also within one document. ``removed`` holds ``start`` and ``end`` (characters of the
    original text, end exclusive) and ``first_id``, the document that keeps the unit. Kept
    units are joined by a line end, paragraphs by two, sentences by nothing. Sentences also
    find a passage that stands between other words of a line.

    Digests are grouped with map-side minima, and only those of several units are joined
    back, so a unit that a third of the rows share is split like any skewed join side.
    Texts cross a shuffle once, when they meet their removals.

    A null text stays null with nothing removed; an empty one stays empty. Rows without
    an id rank first. An empty text has no sentence, so nothing is removed. Rows with equal
    ids are told apart by their text; full repeats of a row count as one and come back as
    often. Other columns are not read.
    """
    if separator not in _GLUE:
        raise ValueError("separator must be LINE, PARAGRAPH or SENTENCE")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    text = F.coalesce("text", F.lit(""))
    cut = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)) if separator == SENTENCE else F.split(text, separator)
    if separator == SENTENCE:
        gaps = F.array_repeat(F.lit(0), F.size("units"))
    elif separator == LINE:
        gaps = F.array_repeat(F.lit(1), F.size("units"))
    else:
        gaps = F.transform(F.regexp_extract_all(text, F.lit(f"({separator})"), F.lit(1)), lambda g: F.length(g))
    sizes = F.zip_with("units", gaps, lambda u, g: F.length(u).cast("bigint") + F.coalesce(g, F.lit(0)))
    begins = running(F.concat(F.array(F.lit(0).cast("bigint")), F.slice(sizes, F.lit(1), F.greatest(F.size("units") - 1, F.lit(0)))))
    placed = F.zip_with("units", begins, lambda u, b: F.struct(u.alias("unit"), b.alias("start")))
    units = rows.withColumn("units", cut).select("doc_id", "h", F.posexplode(placed).alias("pos", "u"))
    units = units.select("doc_id", "h", "pos", "u.start", (F.col("u.start") + F.length("u.unit")).alias("end"), normalised(F.col("u.unit")).alias("normal"))
    units = stored(units.filter((F.length("normal") >= min_chars) & (F.size(F.split("normal", " ")) >= min_words)).select("doc_id", "h", "pos", "start", "end", F.unhex(F.sha2("normal", 256)).alias("digest")), "units")

    place = F.struct("doc_id", "h", "pos")
    firsts = units.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    again = units.join(firsts, "digest").filter(~place.eqNullSafe(F.col("first")))
    gone = again.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(F.struct("pos", "start", "end", F.col("first.doc_id").alias("first_id")))).alias("gone"))
    gone = gone.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    joined = joined.withColumn("units", cut).withColumn("gone", F.coalesce("gone", F.expr("filter(array(named_struct('pos', 0, 'start', 0L, 'end', 0L, 'first_id', doc_id)), x -> false)")))
    left = F.array_except(F.sequence(F.lit(0), F.size("units") - 1), F.transform("gone", lambda g: g["pos"]))
    kept = F.array_join(F.transform(left, lambda i: F.get("units", i)), _GLUE[separator])
    return joined.select(
        "doc_id",
        F.when(F.size("gone") == 0, F.col("text")).otherwise(kept).alias("text"),
        F.size("units").cast("bigint").alias("n_units"),
        F.size("gone").cast("bigint").alias("n_removed"),
        F.transform("gone", lambda g: F.struct(g["start"].alias("start"), g["end"].alias("end"), g["first_id"].alias("first_id"))).alias("removed"),
    )
