"""Order-independent document fingerprints that add and subtract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import let, with_next

LANES = 16  # sums of 32-bit hashes of whole paragraphs, modulo 2**32
SIGNS = 64  # counts of the set bits of hashes of paragraphs' clauses, modulo 2**16
_TWO = 4294967297  # bits 0 and 32: two counters in one integer


def fingerprint(text: Column) -> Column:
    """``struct<n, lanes, signs, pieces>`` of the text's multiset of paragraphs.

    A paragraph is a line that is not blank, without the spaces around it. ``lanes`` adds
    up wide vectors hashed from whole paragraphs, modulo 2**32; ``n`` counts paragraphs.
    ``signs`` adds up, modulo 2**16, the bits of hashes of each paragraph's clauses (what
    stands between ``. , ; : ! ? |``), and ``pieces`` counts those modulo 2**32; they
    carry the likeness. All parts are sums over paragraphs, so their order does not
    matter, and a paragraph is inserted or deleted by adding or subtracting its own
    fingerprint. Texts that differ in the order of paragraphs or in blank lines alone have
    equal fingerprints. A null or empty text has the zero fingerprint.
    """
    paragraphs_of = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[\\n\\r]+"), lambda p: F.trim(p)), lambda p: p != "")

    def summed(paragraphs: Column) -> Column:
        lane = lambda i: F.aggregate(paragraphs, F.lit(0).cast("bigint"), lambda a, p: (a + F.xxhash64(i, p).bitwiseAND(F.lit(0xFFFFFFFF))).bitwiseAND(F.lit(0xFFFFFFFF)))
        return F.struct(F.size(paragraphs).cast("bigint").alias("n"), F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lane).alias("lanes"))

    return let(paragraphs_of, summed)


def _clauses(text: Column) -> Column:
    """Hashes of the clauses of all paragraphs."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[\\n\\r.,;:!?|]+"), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(parts, lambda p: F.xxhash64(p))


def add_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column; see ``fingerprint``."""
    parts = df.withColumn("_clauses", _clauses(F.col(text_col))).withColumn("_whole", fingerprint(F.col(text_col)))
    packed = F.transform(
        F.sequence(F.lit(0), F.lit(SIGNS // 2 - 1)),
        lambda i: F.aggregate("_clauses", F.lit(0).cast("bigint"), lambda a, h: a + F.call_function("shiftrightunsigned", h, i).bitwiseAND(F.lit(_TWO))),
    )
    low = F.transform("_packed", lambda x: x.bitwiseAND(F.lit(0xFFFF)).cast("int"))
    high = F.transform("_packed", lambda x: F.shiftrightunsigned(x, 32).bitwiseAND(F.lit(0xFFFF)).cast("int"))
    whole = F.struct("_whole.n", "_whole.lanes", F.concat(low, high).alias("signs"), F.size("_clauses").cast("bigint").alias("pieces"))
    return parts.withColumn("_packed", packed).withColumn(name, whole).drop("_clauses", "_whole", "_packed")


def _moved(a: Column, b: Column, sign: int) -> Column:
    def lane(bits):
        size = F.lit(1 << bits).cast("bigint")
        return lambda x, y: F.pmod(x.cast("bigint") + sign * y.cast("bigint"), size)

    return F.struct(
        (a["n"] + sign * b["n"]).alias("n"),
        F.zip_with(a["lanes"], b["lanes"], lane(32)).alias("lanes"),
        F.transform(F.zip_with(a["signs"], b["signs"], lane(16)), lambda x: x.cast("int")).alias("signs"),
        (a["pieces"] + sign * b["pieces"]).alias("pieces"),
    )


def inserted(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return _moved(a, b, 1)


def deleted(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b."""
    return _moved(a, b, -1)


def as_text(fp: Column) -> Column:
    """The fingerprint as hexadecimal digits of fixed width."""
    digits = lambda x, n: F.lower(F.lpad(F.hex(x), n, "0"))
    return F.concat(
        digits(F.pmod(fp["n"], F.lit(1 << 32)), 8),
        F.array_join(F.transform(fp["lanes"], lambda x: digits(x, 8)), ""),
        F.array_join(F.transform(fp["signs"], lambda x: digits(x.cast("bigint"), 4)), ""),
    )


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the shared clauses to all clauses, estimated from the sign counters.

    Each counter gives a sum of random signs; the mean square of the difference of two
    such sums estimates the squared distance of the two multisets. Equal multisets have
    likeness 1, also two empty ones.
    """
    half, size = 1 << 15, 1 << 16

    def square(x: Column) -> Column:
        return x * x

    def energy(pieces: Column, counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("double"), lambda s, c: s + square(pieces.cast("double") - 2 * c))

    apart = F.zip_with(a["signs"], b["signs"], lambda x, y: F.pmod(x - y + F.lit(half), F.lit(size)) - F.lit(half))
    total = energy(a["pieces"], a["signs"]) + energy(b["pieces"], b["signs"])
    return F.when(total == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - energy(a["pieces"] - b["pieces"], apart) / total)))


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form and of the next document.

    The edited form ends with as much of the next document's beginning as the half of
    the text that it replaces. Texts cross the shuffle once, with their fingerprints.
    Null texts are empty; a table of one row has itself as next; an empty table gives no
    rows; rows with equal ids stand in the order of their texts; other columns are not
    read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", ["text", "fp"], derive=lambda df: add_fingerprint(df, "text", "fp"))
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(next_text, 1, int(n_chars div 2)))"))
    return add_fingerprint(rows.drop("text", "next_text"), "edited", "edited_fp")
