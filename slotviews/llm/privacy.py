"""Personal data by pattern, and by contexts that the found data teach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import cut, let, pieces, running, running_max, stored

#: kinds in the order in which spans with one start are listed
KINDS = ("email", "ip", "card", "phone")
# A run of characters that can begin a match is entered at its first one, or where the
# match before has ended, so a long run is read once; possessive repeats do not recurse.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: tokens that can be an identifier: with a digit or an at sign
CANDIDATE = r"(?<!\S)\S*[0-9@]\S*"
#: stands for such a token among the words before another
NEIGHBOUR = "<id>"
#: stands before the first token of a text
START = "<start>"
#: longer words of a context are told apart by their digest
CONTEXT_CHARS = 64
#: spans of a text that are searched together
SPANS = 256
ROUNDS = 3
MIN_SEEDS = 5
MIN_SCORE = 0.8

_SPAN = "struct<start:bigint,kind_no:int,end:bigint,kind:string>"


def occurrences(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: ``array<struct<start, end, match, gap>>``.

    Offsets are characters, as sums over gaps and matches; ``gap`` is what stands between
    the match before and this one.
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    steps = let(both, lambda b: F.zip_with(b["found"], F.slice(b["gaps"], F.lit(1), F.size(b["found"])), lambda m, g: F.struct(m.alias("match"), g.alias("gap"))))

    def placed(steps: Column) -> Column:
        ends = running(F.transform(steps, lambda s: (F.length(s["match"]) + F.length(s["gap"])).cast("bigint")))
        return F.zip_with(steps, ends, lambda s, end: F.struct((end - F.length(s["match"])).alias("start"), end.alias("end"), s["match"].alias("match"), s["gap"].alias("gap")))

    return let(steps, placed)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        x = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=.)", "")
    return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(False)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, "\\."), _small)
    if kind == "card":
        size = F.length(_digits(match))
        return F.when(size.between(12, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds, by start, then by kind."""
    has = {"email": F.contains(text, F.lit("@")), "ip": text.rlike("[0-9]\\.[0-9]"), "card": text.rlike("[0-9][ -]?[0-9]"), "phone": F.contains(text, F.lit("+"))}

    def of(number: int, kind: str) -> Column:
        good = F.filter(occurrences(text, PATTERNS[kind]), lambda m: _valid(kind, m["match"]))
        spans = F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind_no"), m["end"].alias("end"), F.lit(kind).alias("kind")))
        return F.when(has[kind], spans).otherwise(F.from_json(F.lit("[]"), f"array<{_SPAN}>"))

    parts = [of(number, kind) for number, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*parts))


def _word(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", ""))


def _last_words(gap: Column) -> Column:
    """The last two words of what stands before a token, as they are."""
    words = F.substring_index(F.trim(F.regexp_replace(gap, "\\s++", " ")), " ", -2)
    return F.transform(F.filter(F.split(words, " "), lambda w: w != ""), lambda w: F.when(F.length(w) > CONTEXT_CHARS, F.sha2(w, 256)).otherwise(w))


def _pattern(found: Column, mention: Column, i: Column) -> Column:
    """The two words before a mention; a mention among them is NEIGHBOUR.

    Punctuation alone counts as a word, but shows only where there is nothing else. START
    stands for the beginning of the text.
    """
    none, one = F.array().cast("array<string>"), F.array(F.lit(NEIGHBOUR))
    earlier = F.concat(F.when(i > 1, one).otherwise(none), F.when(i > 0, F.concat(F.get(found, i - 1)["words"], one)).otherwise(none))
    before = F.slice(F.concat(F.array(F.lit(""), F.lit("")), F.when(F.size(mention["words"]) < 2, earlier).otherwise(none), mention["words"]), -2, 2)

    def joined(before: Column) -> Column:
        clean = F.array_join(F.transform(before, lambda w: F.when(w == NEIGHBOUR, w).otherwise(_word(w))), " ")
        bare = F.array_join(before, " ")
        return let(clean, lambda c: F.when(F.trim(c) != "", c).when(F.trim(bare) != "", bare).otherwise(START))

    return let(before, joined)


def _grouped(spans: Column) -> Column:
    """Spans in groups of SPANS with the first start and the last end of each."""

    def group(part: Column) -> Column:
        return F.struct(F.get(part, F.lit(0))["start"].alias("first"), F.array_max(F.transform(part, lambda s: s["end"])).alias("last"), part.alias("spans"))

    numbers = F.sequence(F.lit(0), F.floor(F.size(spans) / SPANS).cast("int"))
    return F.transform(numbers, lambda g: let(F.slice(spans, g * SPANS + 1, F.lit(SPANS)), group))


def _overlapping(groups: Column, start: Column, end: Column) -> Column:
    """The first span that shares a character with start to end; only groups that reach there are looked into."""
    near = F.filter(groups, lambda g: (g["first"] < end) & (g["last"] > start))
    return F.get(F.flatten(F.transform(near, lambda g: F.filter(g["spans"], lambda s: (s["start"] < end) & (s["end"] > start)))), F.lit(0))


def _mentions(text: Column, spans: Column) -> Column:
    """Identifier-like tokens, without punctuation around them: place, two words before, seed.

    A base span is one mention, with its own text, whatever tokens it is made of. Spans are
    looked up in groups and texts are cut from pieces, so a long text costs little more than
    its length.
    """

    def mention(m: Column, groups: Column, parts: Column) -> Column:
        head = F.length(F.regexp_extract(m["match"], "^[(\\[{<\"'=:]*", 0))
        tail = F.length(F.regexp_extract(m["match"], "[)\\]}>\"'.,;:!?]*$", 0))
        start, end = m["start"] + head, m["end"] - tail
        own = F.substring(m["match"], head + 1, F.greatest(F.length(m["match"]) - head - tail, F.lit(0)))

        def row(seed: Column) -> Column:
            whole = cut(parts, seed["start"], seed["end"])
            inner = F.coalesce(start > seed["start"], F.lit(False))
            return F.struct(start.alias("start"), end.alias("end"), F.lower(F.coalesce(whole, own)).alias("value"), _last_words(m["gap"]).alias("words"), seed["kind"].alias("seed"), inner.alias("inner"))

        return let(_overlapping(groups, start, end), row)

    def placed(found: Column) -> Column:
        return F.transform(found, lambda m, i: F.struct(m["start"], m["end"], m["value"], _pattern(found, m, i).alias("pattern"), m["seed"], m["inner"]))

    # computed once for each text, outside the lambda of the mentions
    once = F.struct(let(spans, _grouped).alias("groups"), pieces(text).alias("parts"))
    rows = let(once, lambda o: F.transform(occurrences(text, CANDIDATE), lambda m: mention(m, o["groups"], o["parts"])))
    found = F.filter(rows, lambda m: (m["end"] > m["start"]) & ~m["inner"])
    return F.when(text.rlike("[0-9@]"), let(found, placed))


def _shaped(kind: Column, value: Column) -> Column:
    """A new value must look like its kind, if more loosely."""
    digits = F.length(_digits(value))
    return F.when(kind == "email", value.rlike("^[^@]+@[^@]+$")).when(kind == "ip", value.rlike("^[0-9]+([.:][0-9a-f]+){2,}$")).otherwise(digits >= 7)


def _learn(mentions: DataFrame) -> DataFrame:
    """``(pattern, kind)`` that speak for personal data, scored on the graph of both.

    An instance's score is 1 for a seed, else the best score of its patterns in the round
    before. A pattern's score is the mean of its instances' scores, with one instance of
    score 0 added. Both sides are aggregated from distinct edges, so frequent patterns
    and values are sums, never groups held together.
    """
    edges = mentions.groupBy("pattern", "value").agg(F.max("seed").alias("seed"))
    seeds = edges.filter("seed IS NOT NULL").groupBy("value").agg(F.max("seed").alias("kind")).withColumn("score", F.lit(1.0))
    edges = stored(edges.join(edges.filter("seed IS NOT NULL").select("pattern").distinct(), "pattern", "left_semi"), "edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    support = edges.filter("seed IS NOT NULL").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count(F.lit(1)).alias("support"))
    scores, patterns = stored(seeds, "instances"), None
    for _ in range(ROUNDS):
        total = edges.select("pattern", "value").join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
        patterns = stored(total.join(sizes, "pattern").select("pattern", "kind", (F.col("sum") / (F.col("size") + 1)).alias("score")), "patterns")
        fresh = edges.select("pattern", "value").join(patterns, "pattern").join(seeds.select("value"), "value", "left_anti")
        scores = stored(seeds.unionByName(fresh.groupBy("value", "kind").agg(F.max("score").alias("score"))), "instances")
    return patterns.join(support, ["pattern", "kind"]).filter((F.col("support") >= MIN_SEEDS) & (F.col("score") >= MIN_SCORE)).select("pattern", "kind")


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, base, spans)`` for each row; spans are ``start, kind_no, end, kind``.

    ``base`` has what the fixed patterns find, ``spans`` adds what contexts find: tokens
    with a digit or an at sign become mentions, with the two words before them as their
    lexical pattern; a mention among these words is the word NEIGHBOUR, and START stands
    where there are none. Base spans are the seeds. Patterns and instances score each other in
    ROUNDS rounds; a pattern with at least MIN_SEEDS different seeds of one kind and a
    score of MIN_SCORE finds every mention that looks like its kind. Texts are read once
    and never shuffled; the graph is made of their mentions.

    A null or empty text has no spans. Equal ids are told apart by ``text_hash``
    (``xxhash64`` of the text); repeated rows come back as often. A table without seeds
    learns nothing. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), text.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = stored(rows.select("doc_id", "text_hash", "base", _mentions(F.col("text"), F.col("base")).alias("mentions")), "mentions")
    mentions = rows.select("doc_id", "text_hash", F.explode("mentions").alias("m")).select("doc_id", "text_hash", "m.*")
    patterns = _learn(mentions)
    new = mentions.filter("seed IS NULL").join(patterns, "pattern").filter(_shaped(F.col("kind"), F.col("value")))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    span = F.struct(F.col("start"), number.alias("kind_no"), F.col("end"), F.col("kind"))
    new = new.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).agg(F.collect_set(span).alias("new"))
    joined = rows.join(new, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h")), "left")
    spans = F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "new")))
    return joined.select("doc_id", "text_hash", "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every stretch of touching spans replaced by its first kind in brackets."""

    def pieced(both: Column) -> Column:
        parts, spans, ends = both["parts"], both["spans"], both["ends"]

        def step(s: Column, i: Column) -> Column:
            before = F.coalesce(F.when(i > 0, F.get(ends, i - 1)), F.lit(0).cast("bigint"))
            return F.when(s["start"] >= before, F.concat(cut(parts, before, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

        last = F.coalesce(F.element_at(ends, -1), F.lit(0).cast("bigint"))
        return F.concat(F.array_join(F.transform(spans, step), ""), cut(parts, last, F.length(text).cast("bigint")))

    once = F.struct(pieces(text).alias("parts"), spans.alias("spans"), running_max(F.transform(spans, lambda s: s["end"])).alias("ends"))
    return F.when(text.isNotNull(), F.when(F.size(spans) == 0, text).otherwise(let(once, pieced)))
