"""Every operator over its whole table, and the SQL that states the result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.llm import centroids, chat, decontam, fingerprints, jaccard, langid, negatives, packing, privacy, substrings, suffixes, urlrules, warc
from slotviews.llm.common import scaled, table, with_next

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_chat_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with the end of the next conversation.

    Chosen is the conversation. Rejected has, in place of its last assistant turn and what
    follows, the next conversation's last assistant turn and what follows. Turns without a
    number come first and stay with their conversation; rows without a conversation's id
    belong to none and make no pair.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    last = turns.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("reply"), F.max("turn").alias("end"))
    last = last.select("conv_id", F.coalesce("reply", F.col("end") + 1).alias("cut"))
    dealt = with_next(last, "conv_id", ["conv_id", "cut"])
    chosen = turns.withColumnRenamed("conv_id", "pair_id")
    before = turns.join(dealt, "conv_id").filter("turn IS NULL OR turn < cut").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    tails = turns.join(last, "conv_id").filter("turn >= cut").select("conv_id", (F.col("turn") - F.col("cut")).alias("after"), "role", "text")
    tail = dealt.select(F.col("conv_id").alias("pair_id"), "cut", F.col("next_conv_id").alias("conv_id")).join(tails, "conv_id")
    rejected = before.unionByName(tail.select("pair_id", (F.col("cut") + F.col("after")).alias("turn"), "role", "text"))
    return chat.preference_pairs(chosen, rejected)


OP1_SQL = """
WITH last AS (SELECT conv_id, coalesce(max(turn) FILTER (role = 'assistant'), max(turn) + 1) AS cut FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
dealt AS (SELECT conv_id, cut, coalesce(lead(conv_id) OVER (ORDER BY conv_id), first_value(conv_id) OVER (ORDER BY conv_id)) AS next_id FROM last),
sides AS (
  SELECT conv_id AS pair_id, 0 AS side, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT c.conv_id, 1, turn, role, text FROM conversations c JOIN dealt USING (conv_id) WHERE turn IS NULL OR turn < cut
  UNION ALL SELECT d.conv_id, 1, d.cut + c.turn - l.cut, role, text FROM dealt d JOIN last l ON l.conv_id = d.next_id JOIN conversations c ON c.conv_id = d.next_id AND c.turn >= l.cut),
placed AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos, '<|' || coalesce(role, '') || chr(124) || '>' || chr(10) AS head FROM sides),
cut AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.pos, b.pos)) AS cut
  FROM (FROM placed WHERE side = 0) a FULL JOIN (FROM placed WHERE side = 1) b ON a.pair_id = b.pair_id AND a.pos = b.pos
  WHERE a.pair_id IS NULL OR b.pair_id IS NULL OR a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1),
parts AS (
  SELECT p.*, CASE WHEN pos < coalesce(cut, 1e9) THEN 'p' WHEN side = 0 THEN 'c' ELSE 'r' END AS part, head || coalesce(text, '') || '<|end|>' || chr(10) AS s
  FROM placed p LEFT JOIN cut USING (pair_id) WHERE side = 0 OR pos >= coalesce(cut, 1e9)),
ends AS (SELECT *, sum(length(s)) OVER (PARTITION BY pair_id, part ORDER BY pos) AS done FROM parts),
spans AS (SELECT *, CASE WHEN role = 'assistant' THEN (done - length(s) + length(head))::BIGINT::VARCHAR || ':' || (done - 1)::BIGINT::VARCHAR END AS span FROM ends)
SELECT pair_id,
  coalesce(string_agg(s, '' ORDER BY pos) FILTER (part = 'p'), '') AS prompt,
  coalesce(string_agg(s, '' ORDER BY pos) FILTER (part = 'c'), '') AS chosen,
  coalesce(string_agg(s, '' ORDER BY pos) FILTER (part = 'r'), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY pos) FILTER (part = 'c'), '') AS chosen_mask,
  coalesce(string_agg(span, ',' ORDER BY pos) FILTER (part = 'r'), '') AS rejected_mask,
  count(*) FILTER (part = 'p') AS prompt_turns, count(*) FILTER (part = 'c') AS chosen_turns, count(*) FILTER (part = 'r') AS rejected_turns
FROM spans GROUP BY pair_id
"""


def op2_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edited_and_next(table(spark, sf_dir, "documents"))
    fp, edited, following = F.col("fp"), F.col("edited_fp"), F.col("next_fp")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(fp).alias("fingerprint"),
        fingerprints.as_text(edited).alias("edited_fingerprint"),
        fingerprints.likeness(fp, edited).alias("near_edited"),
        fingerprints.likeness(fp, following).alias("near_next"),
    )


def op3_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)
    return hits.select("doc_id", "item_id", "similarity", "distance", "start", "end")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.dedup_units(table(spark, sf_dir, "documents"), separator=substrings.SENTENCE, min_words=15)
    spans = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["end"], r["first_id"])), ",")
    return rows.select("doc_id", "text", "n_units", "n_removed", spans.alias("removed"))


OP4_SQL = r"""
WITH units AS (SELECT doc_id, text, regexp_extract_all(text, '(?s).*?(?:\n|[.!?] )|.+\z') AS u FROM documents),
flat AS (SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS pos FROM units),
placed AS (SELECT *, sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY pos) AS stop, trim(regexp_replace(lower(unit), '[^\pL\pN]+', ' ', 'g')) AS normal FROM flat),
ranked AS (SELECT *, row_number() OVER (PARTITION BY normal ORDER BY doc_id, pos) AS nth, first_value(doc_id) OVER (PARTITION BY normal ORDER BY doc_id, pos) AS first_id FROM placed),
judged AS (SELECT *, nth > 1 AND len(string_split(normal, ' ')) >= 15 AS gone FROM ranked)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(unit, '' ORDER BY pos) FILTER (NOT gone), '') END AS text, count(unit) AS n_units, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg((stop - length(unit))::BIGINT::VARCHAR || ':' || stop::BIGINT::VARCHAR || ':' || first_id::VARCHAR, ',' ORDER BY pos) FILTER (gone), '') AS removed
FROM documents d LEFT JOIN judged j USING (doc_id) GROUP BY d.doc_id, d.text
"""


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = privacy.personal_spans(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in privacy.KINDS]  # noqa: B023
    return rows.select("doc_id", *counts, F.sha2(privacy.listed(F.col("base")), 256).alias("base_sha256"), privacy.listed(F.col("spans")).alias("spans"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.kept_bytes(suffixes.earlier_strings(table(spark, sf_dir, "documents")))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["start"])
    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.filter("NOT held_out"))
    rows = langid.predict(docs.select("doc_id", "text", "held_out"), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


#: rules by host and path; they decide before all others
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: patterns of advertising, gambling, adult and spam pages and of pages without prose
PATTERNS = (
    (".ads-", "block"), ("-ads.", "block"), (".ads.", "block"), ("/ads/", "block"), ("/ads/transparency/", "allow"), ("/adserver/", "block"), ("||doubleclick.net^", "block"),
    (".tracker.", "block"), ("-track.", "block"), (".spam-", "block"), ("-spam.", "block"), ("/spam/", "block"), ("/anti-spam/", "allow"),
    (".casino-", "block"), ("-casino.", "block"), (".casino.", "block"), ("/casino/", "block"), ("-bets.", "block"), (".bets-", "block"), ("/betting/", "block"), ("/poker/", "block"),
    ("-pills.", "block"), (".pills-", "block"), ("/pills/", "block"), ("-pharmacy.", "block"), (".adult-", "block"), ("-adult.", "block"), ("/adult/", "block"), ("/adult/education/", "allow"), (".porn", "block"), ("xxx.", "block"),
    ("/wp-login.php^", "block"), ("/xmlrpc.php^", "block"), ("/cgi-bin/", "block"), ("/cart/checkout^", "block"), (".exe|", "block"), (".apk|", "block"), (".zip|", "block"), (".torrent|", "block"),
    ("?phpsessid=", "block"), ("^jsessionid=", "block"), ("^replytocom=", "block"), ("/feed/*/comments^", "block"), ("||*.example.org/en/404^", "block"),
)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [(rule, "||" + rule, action, 1, False) for rule, action in HOST_RULES]
    rules += [(pattern, pattern, action, 0, True) for pattern, action in PATTERNS]
    rows = urlrules.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(rules, urlrules.RULES))
    return rows.select("page_id", "host", "path", F.when(F.col("level") == 1, F.col("rule")).alias("rule"), "verdict", "pattern")


OP11_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, rest IS NOT NULL AS there, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, coalesce(regexp_extract(rest, '(?s)^[^/?#]*(.*)', 1), '') AS tail FROM cut),
rules(host, path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(action, length(r.host || r.path)) AS action
  FROM (SELECT DISTINCT page_id, p.host, p.path FROM parts p) p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY page_id),
patterns(pattern, action, regex) AS (VALUES
  ('.ads-', 'block', '\.ads-'), ('-ads.', 'block', '-ads\.'), ('.ads.', 'block', '\.ads\.'), ('/ads/', 'block', '/ads/'), ('/ads/transparency/', 'allow', '/ads/transparency/'), ('/adserver/', 'block', '/adserver/'),
  ('||doubleclick.net^', 'block', '^[^/?#]*\.doubleclick\.net([^a-zA-Z0-9_.%-]|$)'), ('.tracker.', 'block', '\.tracker\.'), ('-track.', 'block', '-track\.'), ('.spam-', 'block', '\.spam-'), ('-spam.', 'block', '-spam\.'),
  ('/spam/', 'block', '/spam/'), ('/anti-spam/', 'allow', '/anti-spam/'), ('.casino-', 'block', '\.casino-'), ('-casino.', 'block', '-casino\.'), ('.casino.', 'block', '\.casino\.'), ('/casino/', 'block', '/casino/'),
  ('-bets.', 'block', '-bets\.'), ('.bets-', 'block', '\.bets-'), ('/betting/', 'block', '/betting/'), ('/poker/', 'block', '/poker/'), ('-pills.', 'block', '-pills\.'), ('.pills-', 'block', '\.pills-'), ('/pills/', 'block', '/pills/'),
  ('-pharmacy.', 'block', '-pharmacy\.'), ('.adult-', 'block', '\.adult-'), ('-adult.', 'block', '-adult\.'), ('/adult/', 'block', '/adult/'), ('/adult/education/', 'allow', '/adult/education/'), ('.porn', 'block', '\.porn'), ('xxx.', 'block', 'xxx\.'),
  ('/wp-login.php^', 'block', '/wp-login\.php([^a-zA-Z0-9_.%-]|$)'), ('/xmlrpc.php^', 'block', '/xmlrpc\.php([^a-zA-Z0-9_.%-]|$)'), ('/cgi-bin/', 'block', '/cgi-bin/'), ('/cart/checkout^', 'block', '/cart/checkout([^a-zA-Z0-9_.%-]|$)'),
  ('.exe|', 'block', '\.exe$'), ('.apk|', 'block', '\.apk$'), ('.zip|', 'block', '\.zip$'), ('.torrent|', 'block', '\.torrent$'), ('?phpsessid=', 'block', '[?]phpsessid='), ('^jsessionid=', 'block', '([^a-zA-Z0-9_.%-]|$)jsessionid='),
  ('^replytocom=', 'block', '([^a-zA-Z0-9_.%-]|$)replytocom='), ('/feed/*/comments^', 'block', '/feed/.*/comments([^a-zA-Z0-9_.%-]|$)'), ('||*.example.org/en/404^', 'block', '^[^/?#]*\..*\.example\.org/en/404([^a-zA-Z0-9_.%-]|$)')),
seen AS (SELECT DISTINCT '.' || host || tail AS subject FROM parts WHERE there),
matched AS (SELECT subject, first(pattern ORDER BY length(pattern) DESC, action, pattern) AS pattern, first(action ORDER BY length(pattern) DESC, action, pattern) AS action
  FROM seen, patterns WHERE regexp_matches(subject, regex, 'is') GROUP BY subject)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, m.action, 'allow') AS verdict, coalesce('||' || f.rule, m.pattern) AS pattern
FROM parts p LEFT JOIN fits f USING (page_id) LEFT JOIN matched m ON p.there AND m.subject = '.' || p.host || p.tail
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), scaled(F.col("embedding"), 256).alias("v"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score FROM usable a, usable b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score QUALIFY rank <= 3
"""


def op13_drift_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = centroids.integer_vectors(table(spark, sf_dir, "embeddings"), 64, 256)
    rows = centroids.with_inertia(*centroids.cluster(vectors, centroids.seeds(vectors, 40, "2"), 5))
    printed = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(printed, 256).alias("centroid_sha256"))


_ROUND = """
a{n} AS MATERIALIZED (SELECT vec_id, v, k, list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c) AS d FROM kept, c{n} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1),
m{n} AS (SELECT k, pos, floor(sum(x) / count(*)) AS mean FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{n}) GROUP BY k, pos),
c{next} AS MATERIALIZED (SELECT k, coalesce(l.c, old.c) AS c FROM c{n} old LEFT JOIN (SELECT k, list(mean ORDER BY pos) AS c FROM m{n} GROUP BY k) l USING (k)),"""
OP13_SQL = """
WITH kept AS MATERIALIZED (SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, v AS c FROM kept QUALIFY k < 40),""" + "".join(_ROUND.format(n=n, next=n + 1) for n in range(6)) + """
named AS (SELECT k, sha256(array_to_string([x::BIGINT for x in c], ',')) AS centroid_sha256 FROM c5)
SELECT vec_id, k::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256 FROM a5 JOIN named USING (k)
"""


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_chat_preference": (op1_chat_preference, OP1_SQL),
    "op2_multiset_fingerprint": (op2_multiset_fingerprint, None),
    "op3_simhash_decontamination": (op3_simhash_decontamination, None),
    "op4_line_dedup": (op4_line_dedup, OP4_SQL),
    "op5_ngram_jaccard": (op5_ngram_jaccard, None),
    "op6_bootstrapped_pii": (op6_bootstrapped_pii, None),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_language_codes": (op8_language_codes, None),
    "op9_sum_of_squares_packing": (op9_sum_of_squares_packing, None),
    "op10_warc_index": (op10_warc_index, None),
    "op11_url_rules": (op11_url_rules, OP11_SQL),
    "op12_hard_negatives": (op12_hard_negatives, OP12_SQL),
    "op13_drift_kmeans": (op13_drift_kmeans, OP13_SQL),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
