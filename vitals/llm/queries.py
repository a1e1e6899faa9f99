"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    exact_dedup,
    language,
    lm_scoring,
    mixing,
    periodic_runs,
    prefix_trie,
    quality_lines,
    repeats,
    secret_ledger,
    simhash,
    url_filter,
)
from .common import WORD, new_path, stored

#: Words in the names of hosts whose pages are listed, and the contract's rules.
LISTED_HOSTS = "adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm"
URL_RULES = (
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


def op1_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.get("positions", F.lit(0)).alias("first_position"), F.get("positions", F.lit(1)).alias("second_position"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: pages of some hosts, and whatever page has more links than paragraphs, on any host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    farm = F.regexp_count("html", F.lit("<a ")) > F.regexp_count("html", F.lit("<p>"))
    listed = pages.filter(url_filter.host_of(F.col("url")).rlike(rf"(^|\.)({LISTED_HOSTS})\.") | farm)
    return url_filter.judge(pages, listed.select("url"), URL_RULES)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_documents(spark, sf_dir))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, sf_dir), with_text=False)


def op6_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.clean(_documents(spark, sf_dir), with_text=False)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(_documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_documents(spark, sf_dir))


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits: the texts without their last lines, under an older rule for hexadecimal keys; then the texts.

    The second run scans texts that the first has not seen, and the others for the new version of that rule.
    ``n_scans`` counts the rule versions that a text was scanned with.
    """
    documents, ledger = _documents(spark, sf_dir), new_path(spark, "secret-ledger")
    earlier = documents.select("doc_id", F.regexp_replace("text", r"\n[^\n]*\z", "").alias("text"))
    older = [replace(r, pattern="[0-9a-f]{32,}", version=0) if r.kind == "hex" else r for r in secret_ledger.RULES]
    stored(secret_ledger.scan(earlier, ledger, rules=older), "secret-first-commit")
    found = secret_ledger.scan(documents, ledger)
    found = found.join(secret_ledger.scans_of(spark, ledger), "digest")
    return secret_ledger.digest_spans(found)


def _with_planted_period(documents: DataFrame) -> DataFrame:
    """The contract's texts: of a tenth of the documents, words from a on repeat with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planned = (
        documents.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
        .withColumn("words", F.when((F.col("h") % 10 == 0), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
        .withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    )
    planted = F.expr("array_join(transform(sequence(0, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return planned.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.find_runs(_with_planted_period(_documents(spark, sf_dir))))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_benchmark(_documents(spark, sf_dir), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns, ids = prefix_trie.share_heads(prefix_trie.number_turns(conversations), every=100, most=5)
    return prefix_trie.trie(turns, ids)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op1_page_language": op1_page_language,
    "op2_mixing": op2_mixing,
    "op3_url_filter": op3_url_filter,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_repeats": op5_repeats,
    "op6_quality_lines": op6_quality_lines,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_bpe": op9_bpe,
    "op10_secret_ledger": op10_secret_ledger,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontaminate": op12_decontaminate,
    "op13_prefix_trie": op13_prefix_trie,
}

_MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS place FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) % 3 AS turn
  FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 2e0 * source_size AS most,
    CASE turn WHEN 1 THEN 3e0 WHEN 2 THEN 1e0 ELSE 2e0 END AS weight,
    CASE turn WHEN 1 THEN 4e0 WHEN 2 THEN 0.5e0 ELSE 2e0 END AS a,
    CASE turn WHEN 1 THEN 2e0 WHEN 2 THEN 1.5e0 ELSE 2e0 END AS b FROM s),
l AS (
  SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(most) OVER (
      ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
o AS (SELECT first(level ORDER BY most / weight, source NULLS LAST) AS level FROM l WHERE level * weight <= most),
t AS (
  SELECT l.source, source_size, a, b, coalesce(least(most, o.level * weight), most) AS target
  FROM l LEFT JOIN o ON true),
p AS (
  SELECT d.doc_id, size, source_size, target, a, b,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      + size / 2e0 AS m
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
m AS (
  SELECT *, CASE WHEN size > 0 AND m <= target THEN m / target END AS one,
    CASE WHEN size > 0 AND m + source_size <= target THEN (m + source_size) / target END AS two FROM p)
SELECT doc_id, size, source_size, target,
  size * ((one IS NOT NULL)::BIGINT + (two IS NOT NULL)::BIGINT) AS taken,
  CASE WHEN a = b THEN one ELSE (sqrt(a * a + 4 * ((b - a) / 2) * (one * (a + b) / 2)) - a) / (2 * ((b - a) / 2)) END AS first_position,
  CASE WHEN a = b THEN two ELSE (sqrt(a * a + 4 * ((b - a) / 2) * (two * (a + b) / 2)) - a) / (2 * ((b - a) / 2)) END AS second_position
FROM m"""

_URL_SQL = rf"""
WITH parts AS (
  SELECT page_id, url, len(regexp_extract_all(html, '<a ')) > len(regexp_extract_all(html, '<p>')) AS farm,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path,
    [p FOR p IN string_split(coalesce(regexp_extract(url, '^[^#?]*\?([^#]*)', 1), ''), '&')
      IF p <> '' AND NOT regexp_matches(p, '^(?:utm_[a-z]+|ref|fbclid|gclid)=')] AS params
  FROM pages),
forms AS (
  SELECT *, CASE WHEN host <> '' THEN concat(regexp_replace(host, '^www\.|:(?:80|443)$', '', 'g'),
      regexp_replace(path, '(?:/index\.html?)?/*$', ''),
      CASE WHEN len(params) > 0 THEN concat('?', array_to_string(list_sort(params), '&')) ELSE '' END) END AS canonical
  FROM parts),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
    coalesce(canonical IN (SELECT canonical FROM forms
      WHERE canonical IS NOT NULL AND (farm OR regexp_matches(host, '(^|\.)({LISTED_HOSTS})\.'))), false) AS listed
  FROM forms)
SELECT page_id, host, path, rule, listed, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


_QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
t AS (
  SELECT doc_id, i, CASE WHEN lead(word, 2) OVER o IS NOT NULL
    THEN concat(word, ' ', lead(word) OVER o, ' ', lead(word, 2) OVER o) END AS triple
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT doc_id, i, triple IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, triple) > 1 AS again FROM t),
r AS (
  SELECT doc_id, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS covered
  FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
words AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE covered) AS n_repeat_words FROM r GROUP BY doc_id),
split AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM d)),
lines AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    len(regexp_extract_all(line, '[|»›•·]')) AS separators, len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT *, NOT dup AND NOT (separators >= 3 AND separators * 4 >= n) AND symbols <= 0.5 * n
    AND NOT regexp_matches(line, 'all rights reserved|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)|we use cookies|javascript|lorem ipsum|click here to|sign up for our newsletter|skip to (?:main )?content', 'i')
    AND regexp_matches(line, '[.!?…。！？]["''”’»)\]]*(?:\s|$)') AS stays
  FROM lines),
left_ AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dup) AS n_dup_lines,
    count(*) FILTER (WHERE NOT stays) AS n_lines_removed,
    CAST(coalesce(sum(n) FILTER (WHERE stays), 0) AS BIGINT) AS n_words_kept
  FROM judged GROUP BY doc_id),
m AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_lines_removed, 0) AS n_lines_removed, coalesce(n_words_kept, 0) AS n_words_kept
  FROM d LEFT JOIN words USING (doc_id) LEFT JOIN left_ USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words_kept >= 0.5 * n_words AS kept
FROM m"""


#: Kind, pattern, checked group and its least length, written anew here, so that a wrong rule of the operator shows.
_SECRETS = (
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww](?:[Oo][Rr])?[Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", "gh[oprsu]_[0-9A-Za-z]+", 0, 40),
    ("jwt", r"eyJ[-_0-9A-Za-z]{8,}[.][-_0-9A-Za-z]{8,}[.][-_0-9A-Za-z]{8,}", 0, 1),
)


def _secrets_sql() -> str:
    found = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS place, '{kind}' AS kind, {least} AS least, string_split_regex(text, $${pattern}$$) AS gaps,"
        f" regexp_extract_all(text, $${pattern}$$) AS hits, regexp_extract_all(text, $${pattern}$$, {group}) AS parts"
        f" FROM documents WHERE regexp_matches(text, $${pattern}$$)"
        for i, (kind, pattern, group, least) in enumerate(_SECRETS)
    )
    return f"""
WITH found AS ({found}),
each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found),
spans AS (
  SELECT doc_id, place, kind, CAST(list_sum([length(g) FOR g IN gaps[1:i]])
    + coalesce(list_sum([length(h) FOR h IN hits[1:i - 1]]), 0) AS BIGINT) AS begin, length(hits[i]) AS size
  FROM each WHERE length(parts[i]) >= least),
texts AS (SELECT *, concat(kind, ':', begin, ':', begin + size) AS span FROM spans),
joined AS (
  SELECT doc_id, count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access,
    count(*) FILTER (WHERE place = 2) AS n_hex, string_agg(span, ',' ORDER BY begin, place) FILTER (WHERE place < 3) AS base,
    string_agg(span, ',' ORDER BY begin, place) AS spans
  FROM texts GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(CASE WHEN coalesce(text, '') IN (SELECT coalesce(regexp_replace(text, '\\n[^\\n]*\\z', ''), '') FROM documents)
    THEN 7 ELSE 6 END AS BIGINT) AS n_scans
FROM documents LEFT JOIN joined USING (doc_id)"""


_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAKS_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l,
    unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ') FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS gram
  FROM b WHERE len(w) > 0),
grams AS (
  SELECT r, l, unnest([{{'i': i, 'gram': array_to_string(w[i:i + l - 1], ' ')}} FOR i IN range(1, len(w) - l + 2)]) AS hit
  FROM d, (SELECT DISTINCT l FROM patterns) WHERE len(w) >= l),
hits AS (SELECT r, hit.i AS i, l, item_id FROM grams JOIN patterns USING (l) WHERE hit.gram = patterns.gram),
covered AS (
  SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + l)) AS k FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""

# DuckDB has no CRC-32: eight steps of the bitwise definition per byte of the decimal id.
_CRC32 = """xor(4294967295, list_reduce(
    [CAST(ascii(ch) AS BIGINT) FOR ch IN string_split(CAST(c AS VARCHAR), '')],
    lambda crc, byte: list_reduce(range(8), lambda v, bit: xor(v >> 1, (v & 1) * 3988292384), xor(crc, byte)),
    CAST(4294967295 AS BIGINT)))"""

_TRIE_SQL = """
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS o,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT c, list(said ORDER BY o) AS own FROM t GROUP BY c),
h AS (SELECT c, own, CRC32 % 6 AS h FROM whole),
built AS (
  SELECT h.c, list_concat(coalesce(base.own, [])[1:h.h], h.own[h.h + 1:]) AS turns
  FROM h LEFT JOIN whole base ON base.c = h.c - h.c % 100),
paths AS (SELECT c, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM built),
p AS (SELECT c, size, depth, turns[1:depth] AS node, turns[1:depth - 1] AS up, CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS chars FROM paths),
n AS (
  SELECT depth, node, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * max(chars) AS weight,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = depth), '') AS ids, max(up) AS up
  FROM p GROUP BY depth, node),
k AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY depth, up),
full_ AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.depth = n.depth AND k.node = n.node),
below AS (
  SELECT a.depth, a.node, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, CAST(sum(f.weight) AS BIGINT) AS saved_tokens
  FROM full_ f JOIN p a ON a.c = f.c AND a.depth <= f.depth GROUP BY a.depth, a.node)
SELECT f.c AS conv_id, f.depth, u.c AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(f.ids) AS ends_sha256
FROM full_ f JOIN below b ON b.depth = f.depth AND b.node = f.node
LEFT JOIN full_ u ON u.depth = f.depth - 1 AND u.node = f.up""".replace("CRC32", _CRC32)


_REPEATS_SQL = """
WITH d AS (
  SELECT doc_id, raw, octet_length(raw) AS n FROM (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents)),
w AS (
  SELECT doc_id, i, raw[i:i + 49] AS s FROM (SELECT doc_id, raw, unnest(range(1, n - 48)) AS i FROM d WHERE n >= 50)),
hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE least < doc_id),
started AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS new FROM hit),
numbered AS (SELECT *, count_if(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM started),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 49 AS z FROM numbered GROUP BY doc_id, k),
sums AS (SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, min(a) AS first FROM spans GROUP BY doc_id),
pieces AS (
  SELECT doc_id, raw, 1 AS f, coalesce(first - 1, n) AS t FROM d LEFT JOIN sums USING (doc_id)
  UNION ALL
  SELECT doc_id, raw, z + 1, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a) - 1, n) FROM spans JOIN d USING (doc_id)),
kept AS (SELECT doc_id, unhex(string_agg(hex(raw[f:t]), '' ORDER BY f)) AS bytes FROM pieces GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(bytes) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)"""


LLM_SQL: dict[str, str] = {
    "op5_repeats": _REPEATS_SQL,
    "op12_decontaminate": _LEAKS_SQL,
    "op13_prefix_trie": _TRIE_SQL,
    "op2_mixing": _MIXING_SQL,
    "op3_url_filter": _URL_SQL,
    "op6_quality_lines": _QUALITY_SQL,
    "op10_secret_ledger": _secrets_sql(),
    "op7_exact_dedup": r"""
        WITH normal AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
        FROM normal WINDOW same AS (PARTITION BY text)""",
}
