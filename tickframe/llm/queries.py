"""The registered queries of the corpus operators, each over its whole table, and the SQL that DuckDB runs for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import byte_bpe, chat_format, decontaminate, html_extract, jaccard_join, line_dedup, phrases, quality_rules, secret_scan, sharding, spelling, toxicity, warc


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(table(spark, sf_dir, "documents"))


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, and conversation -7, whose texts imitate control strings."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    fake = spark.createDataFrame([(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], rows.schema)
    return chat_format.digests(rows.unionByName(fake))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), rank_file())


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_text_hash")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).drop("host_rate")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), 40)
    return placed.select(F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH lines AS (
    SELECT doc_id, text, generate_subscripts(l, 1) AS pos, unnest(l) AS line
    FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)),
full_lines AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM lines WHERE trim(line) <> ''),
windows AS (
    SELECT doc_id, k, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS body
    FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
later AS (
    SELECT doc_id, k FROM (
        SELECT doc_id, k, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS n FROM windows WHERE body IS NOT NULL)
    WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, k + j AS k FROM later, (SELECT unnest([0, 1, 2]) AS j)),
kept AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
    FROM lines l LEFT JOIN full_lines f ON l.doc_id = f.doc_id AND l.pos = f.pos
    LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.k = g.k
    WHERE g.k IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
       coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept t USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) n USING (doc_id)
"""

OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
best AS (SELECT b, max(page_id) AS chosen FROM p GROUP BY b)
SELECT page_id, octet_length(p.b)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substring(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> chosen THEN chosen END AS refers_to
FROM p JOIN best ON best.b = p.b
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ig AS (SELECT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM (SELECT *, least(len(w), 10) AS n FROM i WHERE len(w) > 0))),
dg AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM ig))),
h AS (SELECT DISTINCT dg.doc_id, dg.n, dg.p, ig.item_id FROM dg JOIN ig ON ig.g = dg.g AND ig.n = dg.n),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS pos FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS s FROM h GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(s, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p : p + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d)),
r AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS pos FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY 1),
l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY 1),
c AS (SELECT d.doc_id, d.host, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
      coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN l ON l.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM b GROUP BY 1),
mo AS (SELECT sum(f) / sum(n) AS m, avg((f / n) * (f / n)) - avg(f / n) * avg(f / n) - (sum(f) / sum(n)) * (1 - sum(f) / sum(n)) * avg(1 / n) AS v FROM hosts),
pr AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1), 1e6) ELSE 1e6 END AS k FROM mo),
ve AS (SELECT host, s - 2 * sqrt(s * (1 - s) / (n + k + 1)) AS low, m FROM (SELECT host, n, k, m, (f + m * k) / (n + k) AS s FROM hosts, pr)),
j AS (SELECT b.*, low > m AS host_suspect, low > 0.5 AS bad, n_words < 40 OR 200 * n_repeat_words > 30 * n_words OR 8 * n_symbols > word_chars OR 100 * n_dup_lines > 30 * n_words AS strict FROM b JOIN ve ON ve.host IS NOT DISTINCT FROM b.host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AND NOT (host_suspect AND strict) AS kept, host, host_suspect FROM j
"""

OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, w[i : i + k - 1] AS w, k, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
s AS (SELECT c.lang, c.w, c.k, c.a, j, h.a AS l, t.a AS r, (2000000::HUGEINT * c.a // (h.a + t.a))::BIGINT AS score
      FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN f h ON h.lang = c.lang AND h.w = c.w[1 : j] JOIN f t ON t.lang = c.lang AND t.w = c.w[j + 1 : c.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, j) = 1),
inner_w AS (SELECT lang, a, w[i : i + n - 1] AS w FROM (SELECT *, unnest(range(1, k - n + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS n) WHERE n < k)),
top AS (SELECT lang, w, max(a) AS a FROM inner_w GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN top ON top.lang = b.lang AND top.w = b.w WHERE top.a IS NULL OR 100 * top.a < 80 * b.a),
r AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM r JOIN (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1) n ON n.lang = r.lang WHERE r.rank <= 2000
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_html_extract": op2_html_extract,
    "op3_secret_scan": op3_secret_scan,
    "op4_line_windows": op4_line_windows,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_chat_windows": op6_chat_windows,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_winnowing": op8_winnowing,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrases": op11_phrases,
    "op12_sharding": op12_sharding,
    "op13_spelling": op13_spelling,
}
#: Encoding by rank file, model scores, ownership of free tokens, markup and windowed formatting are tested against plain
#: Python instead; so are components, which need an unbounded recursion, seeded orders and words altered by a CRC.
ORACLES: dict[str, str] = {"op1_warc": OP1_SQL, "op4_line_windows": OP4_SQL, "op8_winnowing": OP8_SQL, "op10_quality_rules": OP10_SQL, "op11_phrases": OP11_SQL}
