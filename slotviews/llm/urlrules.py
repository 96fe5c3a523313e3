"""Judgement of URLs by pattern rules that are looked up by their rarest literal token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import stored

RULES = "rule string, pattern string, action string, level int, any_case boolean"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: what a rule without a whole literal token is kept under; every URL has this token
ANY = ""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and the text that patterns are matched against.

    The last is a dot, the host, and all that follows the host; it is null where the URL
    is null or has no ``://``, and host and path are empty there.
    """
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    subject = F.concat(F.lit("."), host, F.regexp_extract(rest, "(?s)^[^/?#]*(.*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), subject


def tokens(subject: Column) -> Column:
    """The different runs of letters and digits of a subject, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(lower_ascii(subject), F.lit("[a-z0-9]+"), F.lit(0)))


def expression(pattern: Column, any_case: Column) -> Column:
    """The regular expression of a pattern.

    ``||`` at the start: where the host or one of its parent domains begins; ``|`` at the
    start: where the host begins; ``|`` at the end: the end of the URL; ``*``: any text;
    ``^``: a character that is no letter, digit or one of ``_-.%``, or the end.
    """
    body = F.regexp_replace(pattern, "^\\|\\|?|\\|$", "")
    body = F.regexp_replace(body, "[\\p{Punct}&&[^*^]]", "\\\\$0")
    body = F.regexp_replace(body, "\\^", "(?:[^\\\\w.%-]|\\\\z)")
    body = F.regexp_replace(body, "\\*+", ".*")
    head = F.when(pattern.startswith("||"), "^[^/?#]*\\.").when(pattern.startswith("|"), "^\\.").otherwise("")
    tail = F.when(F.length(pattern) > 1, F.when(pattern.endswith("|"), "\\z")).otherwise("")
    return F.concat(F.when(any_case, "(?si)").otherwise("(?s)"), head, body, F.coalesce(tail, F.lit("")))


def literals(pattern: Column) -> Column:
    """Tokens that every URL the pattern matches has as a whole."""
    edged = F.regexp_replace(lower_ascii(pattern), "^\\|\\|?|\\|$|\\^", "/")
    return F.array_distinct(F.regexp_extract_all(edged, F.lit("(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), F.lit(0)))


def index(subjects: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under one token: that of its literals which the fewest ``subjects`` have.

    Counts cover all subjects, but only tokens of rules are counted. A rule with a literal
    that no subject has cannot match and is left out. Of equally rare literals the longest,
    then the first by letters stands.
    """
    known = rules.filter("pattern IS NOT NULL AND action IS NOT NULL").dropDuplicates()
    known = known.withColumns({"level": F.coalesce("level", F.lit(0)), "any_case": F.coalesce("any_case", F.lit(False))})
    known = stored(known.select("*", expression(F.col("pattern"), F.col("any_case")).alias("regex"), literals(F.col("pattern")).alias("literals")), "rules")
    wanted = stored(known.select(F.explode("literals").alias("token")).distinct(), "rule-tokens")
    seen = subjects.select(F.explode(tokens(F.col("subject"))).alias("token")).join(wanted, "token", "left_semi")
    seen = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    each = known.select("*", F.explode("literals").alias("token")).join(seen, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    names = ["rule", "pattern", "action", "level", "any_case", "regex"]
    rare = each.groupBy(*names).agg(F.min(F.struct("n", (-F.length("token")).alias("short"), "token")).alias("least"))
    rare = rare.filter("least.n > 0").select(*names, F.col("least.token").alias("token"))
    return stored(rare.unionByName(known.filter(F.size("literals") == 0).select(*names, F.lit(ANY).alias("token"))), "rule-index")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each page: id, url, host, path, the rule that decides and its action.

    ``rules`` has the columns of ``RULES``; ``expression`` says what a pattern means. Rules
    are indexed by their rarest literal token, tokens of URLs fetch candidates, and only
    those run their regular expression; a rule without a whole literal token is a candidate
    for every URL. Of the rules that match, the highest ``level`` decides, then the longest
    pattern, then allow before block, then the smallest pattern and rule. ``verdict`` is its
    action, or ``default`` where none matches.

    The index is a written table, so Spark knows its size: a small one is broadcast and the
    URLs do not move for it, a large one is joined by token, where adaptive execution splits
    a frequent token. Matches are reduced to one for each URL before the shuffle.

    A null URL, or one without ``://``, has an empty host and path and no rule. Rows that
    repeat come back as often, rows without an id too. Rules with a null pattern or action
    are none; a null ``level`` is 0 and a null ``any_case`` false. Columns other than the two named are not read.
    """
    host, path, subject = parts(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    subjects = rows.select("url", subject.alias("subject")).filter("subject IS NOT NULL")
    found = index(subjects, rules)
    fetched = subjects.select("url", "subject", F.explode(F.concat(F.array(F.lit(ANY)), tokens(F.col("subject")))).alias("token"))
    order = F.struct((-F.col("level")).alias("level"), (-F.length("pattern")).alias("length"), "action", "pattern", "rule")
    hits = fetched.join(found, "token").filter("subject RLIKE regex").groupBy("url").agg(F.min(order).alias("first"))
    judged = rows.join(hits, "url", "left")
    first = F.col("first")
    return judged.select(
        "page_id",
        "url",
        host.alias("host"),
        path.alias("path"),
        first["rule"].alias("rule"),
        first["pattern"].alias("pattern"),
        (-first["level"]).alias("level"),
        F.coalesce(first["action"], F.lit(default)).alias("verdict"),
    )
