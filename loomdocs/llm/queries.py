"""Queries of the thirteen training-data operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import conversation_digests, format_conversations

    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return conversation_digests(format_conversations(rows, tokenizer=tokenizer_path()))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeated_windows

    return remove_repeated_windows(_table(spark, sf_dir, "documents"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_output import token_output

    return token_output(_table(spark, sf_dir, "documents"), tokenizer_path())


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_by_bytes

    return shard_by_bytes(_table(spark, sf_dir, "documents"), 24)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    # uneven targets for every source of the table: 0.1 to 1.1 by a hash of its name
    weights = docs.select("source").distinct().select("source", (F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")) % 1000 / 1000 + 0.1).alias("weight"))
    return mix_sources(docs, weights)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import shingle_components

    return shingle_components(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_verdicts

    return quality_verdicts(_table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filters import url_verdicts

    return url_verdicts(_table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify_languages

    return identify_languages(_table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contaminated_documents

    return contaminated_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import filter_audit

    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import conversation_trie

    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(), 1024)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    ops = [op1_chat_formatting, op2_substring_dedup, op3_token_output, op4_sharding, op5_source_mixing, op6_ngram_jaccard_join, op7_quality_rules, op8_url_filters, op9_language_id, op10_benchmark_decontamination, op11_filter_audit, op12_prefix_trie, op13_best_fit_packing, pipeline]
    return {f.__name__: f for f in ops}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_OP2 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT DISTINCT g.doc_id, unnest(range(g.i, g.i + 13)) AS i FROM g JOIN f ON g.s = f.s WHERE f.first < g.doc_id),
k AS (SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) AS kept, count(*) AS n
      FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) u LEFT JOIN r ON r.doc_id = u.doc_id AND r.i = u.i
      WHERE r.i IS NULL GROUP BY u.doc_id)
SELECT w.doc_id, cast(len(w.ws) AS BIGINT) AS n_words, cast(len(w.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id"""

_OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS ws FROM documents),
d AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, array_to_string(ws[i : i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM d a JOIN d b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT w.doc_id, cast(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON m.x = w.doc_id"""

_OP8 = f"""
WITH p AS (SELECT page_id, url,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
h AS (SELECT * FROM (VALUES ('com/en/', 'com', '/en/', 'block'), ('example.com/en/7', 'example.com', '/en/7', 'allow'), ('net/de/', 'net', '/de/', 'block'), ('example.net/de/8', 'example.net', '/de/8', 'block'), ('org/es/', 'org', '/es/', 'block')) AS t(rule, rule_host, start, verdict)),
q AS (SELECT p.*, (SELECT max(lpad(cast(length(h.rule) AS VARCHAR), 9, '0') || h.rule || ' ' || h.verdict) FROM h
        WHERE (p.host = h.rule_host OR right(p.host, length(h.rule_host) + 1) = '.' || h.rule_host) AND starts_with(p.path, h.start)) AS best,
  CASE WHEN url IS NULL THEN NULL
    WHEN regexp_matches(lower(url), '(?:^|[^a-z0-9]|$)responsible-gaming(?:^|[^a-z0-9]|$)') THEN '^responsible-gaming^'
    WHEN regexp_matches(lower(url), '(?:^|[^a-z0-9]|$)casino-') THEN '^casino-'
    WHEN regexp_matches(lower(url), '(?:^|[^a-z0-9]|$)free-bets(?:^|[^a-z0-9]|$)') THEN '^free-bets^'
    WHEN regexp_matches(lower(url), '(?:^|[^a-z0-9]|$)cheap-pills(?:^|[^a-z0-9]|$)') THEN '^cheap-pills^'
    WHEN regexp_matches(lower(url), '(?:^|[^a-z0-9]|$)adult(?:^|[^a-z0-9]|$)') THEN '^adult^'
    WHEN regexp_matches(lower(url), '(?:^|[^a-z0-9]|$)torrent(?:^|[^a-z0-9]|$)download(?:^|[^a-z0-9]|$)') THEN '^torrent^download^'
    WHEN regexp_matches(lower(url), '(?:^|[^a-z0-9]|$)poker(?:^|[^a-z0-9]|$).*(?:^|[^a-z0-9]|$)bonus(?:^|[^a-z0-9]|$)') THEN '^poker^*^bonus^' END AS pattern FROM p)
SELECT page_id, host, path, split_part(substr(best, 10), ' ', 1) AS rule,
  coalesce(split_part(substr(best, 10), ' ', 2), CASE WHEN pattern IS NULL OR pattern = '^responsible-gaming^' THEN 'allow' ELSE 'block' END) AS verdict, pattern FROM q"""

_OP11 = f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
l AS (SELECT doc_id, max(cast(quality = 1 AS INT)) AS good, max(cast(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
  coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), min(t.doc_id) OVER (PARTITION BY text) IS NOT NULL)] AS f FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
m AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, f),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, x.i AS step, part, n, good, toxic, f[o[x.i]] AS fails, list_bool_or([false] || [f[j] for j in o[1 : x.i - 1]]) AS before,
  list_sum([cast(v AS INT) for v in f]) AS n_fails FROM m, o, x),
r AS (SELECT part, o, step, sum(n) FILTER (NOT before AND NOT fails) AS kept, sum(n) FILTER (fails AND NOT before) AS removed, sum(n) FILTER (fails AND before) AS redundant,
  sum(n) FILTER (fails AND n_fails = 1) AS unique_fails, sum(good) FILTER (fails AND NOT before) AS good_lost, sum(toxic) FILTER (fails AND NOT before) AS toxic_lost FROM s GROUP BY part, o, step)
SELECT part, array_to_string([substr('ABCDE', j, 1) for j in o], '') AS filter_order, step, cast(coalesce(kept, 0) AS BIGINT) AS kept, cast(coalesce(removed, 0) AS BIGINT) AS removed,
  cast(coalesce(redundant, 0) AS BIGINT) AS redundant, cast(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, cast(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  cast(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, cast(coalesce(sum(removed) OVER (PARTITION BY part, o[step]), 0) AS BIGINT) AS shapley FROM r"""

#: crc32 of a decimal number, bit by bit
_CRC32 = """xor(4294967295, list_reduce([ord(ch) for ch in string_split(cast(c AS VARCHAR), '')],
  lambda crc, ch: list_reduce([xor(crc, ch), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a & 1) * 3988292384)), 4294967295))"""

_OP12 = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT c, c - c % 20 AS b, {_CRC32} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT i.c, 0 AS own, pos, role, text FROM i JOIN t ON t.c = i.b WHERE pos < h UNION ALL SELECT i.c, 1, pos, role, text FROM i JOIN t ON t.c = i.c WHERE pos >= h),
p AS (SELECT c, count(*) OVER w AS d, cast(list(sha256(length(role) || ':' || role || text)) OVER w AS VARCHAR) AS path, len(regexp_extract_all(text, '[^ 	-]+')) AS words
  FROM r WINDOW w AS (PARTITION BY c ORDER BY own, pos ROWS UNBOUNDED PRECEDING) UNION ALL SELECT c, 0, '', 0 FROM i),
e AS (SELECT c, max(d) AS last FROM p GROUP BY c),
g AS (SELECT path, any_value(d) AS depth, min(p.c) AS conv_id, count(*) AS n_convs, any_value(words) AS words, string_agg(cast(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE d = last) AS ends
  FROM p JOIN e ON e.c = p.c GROUP BY path),
u AS (SELECT g.path, b.path AS parent, x.conv_id AS parent_conv_id FROM g JOIN p b ON b.c = g.conv_id AND b.d = g.depth - 1 JOIN g x ON x.path = b.path),
k AS (SELECT parent, count(*) AS n FROM u GROUP BY parent),
s AS (SELECT a.path, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((g.n_convs - 1) * g.words) AS saved
  FROM g LEFT JOIN k ON k.parent = g.path JOIN p a ON a.c = g.conv_id AND a.d <= g.depth GROUP BY a.path)
SELECT g.conv_id, cast(g.depth AS BIGINT) AS depth, u.parent_conv_id, g.n_convs, cast(coalesce(k.n, 0) AS BIGINT) AS n_children, cast(s.n_leaves AS BIGINT) AS n_leaves, cast(s.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(g.ends, '')) AS ends_sha256 FROM g LEFT JOIN u ON u.path = g.path LEFT JOIN k ON k.parent = g.path JOIN s ON s.path = g.path"""

_OP4 = """
WITH s AS (SELECT doc_id, cast(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size FROM documents),
c AS (SELECT doc_id, size, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM s),
p AS (SELECT doc_id, size, cast(least(23, (before * 2 + size) * 24 // (total * 2)) AS INTEGER) AS shard FROM c)
SELECT doc_id, size, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, cast(NULL AS INTEGER) AS grown_shard FROM p"""


def oracle_sql() -> dict[str, str]:
    """DuckDB has no crc32, so operator 4 is held against brute force in the tests instead."""
    return {"op2_substring_dedup": _OP2, "op6_ngram_jaccard_join": _OP6, "op8_url_filters": _OP8, "op11_filter_audit": _OP11, "op12_prefix_trie": _OP12}
