"""Text expressions over names, keys and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.functions import text as tx
from citeflow.operators.spans import header_end
from citeflow.plans.catalog import query, table

# Words that noise turns into others by reading m as rn.
REPAIR_WORDS = ["mentre", "ment", "mente", "tement", "komment", "hammer"]


@query("SELECT s_suppkey AS id, regexp_replace(s_name, '[^0-9]', '', 'g') AS digits FROM supplier UNION ALL SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') FROM customer")
def digits_only_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), tx.digits_only(F.col("s_name")).alias("digits"))
    return a.unionAll(table(spark, sf_dir, "customer").select("c_custkey", tx.digits_only(F.col("c_name"))))


@query("""
WITH k AS (SELECT o_orderkey, CAST(o_orderkey * 7919 AS VARCHAR) AS n FROM orders), f AS (SELECT o_orderkey, n, lpad(n, 20, '0') AS p FROM k)
SELECT o_orderkey, ltrim(reverse(regexp_replace(reverse(n), '([0-9]{3})', '\\1.', 'g')), '.') AS dotted,
       substr(p, 1, 7) || '-' || substr(p, 8, 2) || '.' || substr(p, 10, 4) || '.' || substr(p, 14, 1) || '.' || substr(p, 15, 2) || '.' || substr(p, 17, 4) AS masked
FROM f
""")
def thousands_and_mask_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("o_orderkey") * 7919).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.with_thousands(n).alias("dotted"), tx.masked(n).alias("masked"))


@query("""
WITH n AS (SELECT o_orderkey, translate(CAST(o_orderkey * 31 AS VARCHAR), '105', 'lOS') AS noisy FROM orders)
SELECT o_orderkey, noisy, regexp_replace(translate(noisy, 'lIOoSsgG', '11005599'), '[^0-9]', '', 'g') AS restored,
       regexp_replace(translate(noisy, 'lIOoSsgG', '11005599'), '[^0-9]', '', 'g') = CAST(o_orderkey * 31 AS VARCHAR) AS same FROM n
""")
def ocr_noise_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = (F.col("o_orderkey") * 31).cast("string")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", clean.alias("clean"), F.translate(clean, "105", "lOS").alias("noisy"))
    restored = tx.read_digits(F.col("noisy"))
    return rows.select("o_orderkey", "noisy", restored.alias("restored"), (restored == F.col("clean")).alias("same"))


@query("""
WITH n AS (SELECT o_orderkey, translate(CAST(o_orderkey * 31 AS VARCHAR), '15', 'lS') AS noisy FROM orders)
SELECT o_orderkey, regexp_matches(noisy, '[0-9][lIOoSsgG]|[lIOoSsgG][0-9]') AS misread FROM n
""")
def ocr_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.translate((F.col("o_orderkey") * 31).cast("string"), "15", "lS")
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.was_misread(noisy).alias("misread"))


@query("""
WITH g AS (SELECT o_orderkey, string_split(translate(CAST(o_orderkey * 7919 % 1000000007 AS VARCHAR), '13', 'l.'), '.') AS parts FROM orders),
e AS (SELECT o_orderkey, parts, unnest(range(1, len(parts) + 1)) AS i FROM g),
p AS (SELECT o_orderkey, i, parts[i] AS x, max(CASE WHEN parts[i] <> '' THEN i END) OVER (PARTITION BY o_orderkey) AS last, bool_or(regexp_matches(parts[i], '[0-9]')) OVER (PARTITION BY o_orderkey) AS any_digit FROM e),
f AS (SELECT o_orderkey, i, CASE WHEN any_digit AND (regexp_matches(x, '[0-9]') OR (len(x) = 1 AND i <> last)) THEN translate(x, 'lIOoSsgG', '11005599') ELSE x END AS y FROM p)
SELECT o_orderkey, string_agg(y, '.' ORDER BY i) AS repaired FROM f GROUP BY o_orderkey
""")
def ocr_group_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.translate((F.col("o_orderkey") * 7919 % 1000000007).cast("string"), "13", "l.")
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.repair_groups(token).alias("repaired"))


@query("""
SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(x, '[ ]*-[ ]*', '-', 'g'), '([0-9]) +([0-9.-])', '\\1\\2', 'g'), '-{2,}', '-', 'g') AS collapsed
FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || ' - ' || CAST(o_custkey AS VARCHAR) || ' --' || o_orderstatus AS x FROM orders)
""")
def number_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.concat(F.col("o_orderkey").cast("string"), F.lit(" - "), F.col("o_custkey").cast("string"), F.lit(" --"), F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.collapse_number(noisy).alias("collapsed"))


@query(f"""
WITH w AS (SELECT unnest(regexp_extract_all(translate(lower(text), '{''.join(tx.PLAIN_LETTERS)}', '{''.join(tx.PLAIN_LETTERS.values())}'), '[a-z]+')) AS word FROM documents)
SELECT word, count(*) AS n FROM w GROUP BY word
""")
def accent_fold_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(tx.fold(F.col("text")), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(f"""
WITH v AS (SELECT unnest({REPAIR_WORDS!r}) AS word), t AS (SELECT replace(word, 'm', 'rn') AS noisy, word FROM v),
w AS (SELECT doc_id, unnest(regexp_extract_all(replace(lower(text), 'm', 'rn'), '[a-z]+')) AS noisy FROM documents)
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM w JOIN t ON w.noisy = t.noisy GROUP BY word
""")
def vocab_repair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words misread m as rn, put right where a closed vocabulary knows the word."""
    known = spark.createDataFrame([(w.replace("m", "rn"), w) for w in REPAIR_WORDS], "noisy string, word string")
    noisy = F.regexp_extract_all(F.replace(F.lower("text"), F.lit("m"), F.lit("rn")), F.lit("[a-z]+"), F.lit(0))
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(noisy).alias("noisy"))
    return words.join(F.broadcast(known), "noisy").groupBy("word").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


@query("""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l),
x AS (SELECT doc_id, i, len(lines[i]) + CASE WHEN i < len(lines) THEN 1 ELSE 0 END AS size, trim(replace(replace(lines[i], chr(13), ' '), chr(9), ' ')) AS bare FROM e),
h AS (SELECT doc_id, i, size, bare = '' OR (len(regexp_replace(bare, '[^\\p{L}]', '', 'g')) >= 3 AND NOT regexp_matches(bare, '\\p{Ll}') AND len(bare) <= 120) OR (len(bare) <= 40 AND NOT regexp_matches(bare, '\\p{Ll}')) AS head FROM x),
b AS (SELECT doc_id, min(CASE WHEN NOT head THEN i END) AS body FROM h GROUP BY doc_id)
SELECT h.doc_id, CAST(sum(CASE WHEN body IS NULL OR i < body THEN size ELSE 0 END) AS BIGINT) AS body_start FROM h JOIN b ON h.doc_id = b.doc_id GROUP BY h.doc_id
""")
def header_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", header_end("text").cast("long").alias("body_start"))


@query("""
WITH a AS (SELECT * FROM (VALUES ('STEEL', 'S'), ('POLISHED STEEL', 'PS'), ('BRASS', 'B'), ('PLATED BRASS', 'PB'), ('TIN', 'T'), ('COPPER', 'C')) AS t(alias, key)),
m AS (SELECT p_partkey, key, row_number() OVER (PARTITION BY p_partkey ORDER BY len(alias) DESC, key) AS k FROM part JOIN a ON contains(upper(p_type), alias))
SELECT part.p_partkey, m.key FROM part LEFT JOIN m ON part.p_partkey = m.p_partkey AND k = 1
""")
def longest_alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of the longest alias that a text contains. Few aliases: an expression, not a join."""
    aliases = {"STEEL": "S", "POLISHED STEEL": "PS", "BRASS": "B", "PLATED BRASS": "PB", "TIN": "T", "COPPER": "C"}
    key = F.lit(None).cast("string")
    for alias, name in sorted(aliases.items(), key=lambda x: (len(x[0]), x[0])):
        key = F.when(F.contains(F.upper("p_type"), F.lit(alias)), name).otherwise(key)
    return table(spark, sf_dir, "part").select("p_partkey", key.alias("key"))


@query("""
WITH t AS (SELECT p_partkey, unnest(string_split(lower(p_type), ' ')) AS tok FROM part)
SELECT tok, CASE tok WHEN 'standard' THEN 'AgRg|RR' WHEN 'small' THEN 'AgInt' ELSE upper(tok) END AS codes, count(*) AS n FROM t GROUP BY tok
""")
def token_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.create_map(F.lit("standard"), F.array(F.lit("AgRg"), F.lit("RR")), F.lit("small"), F.array(F.lit("AgInt")))
    tokens = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_type"), " ")).alias("tok"))
    counted = tokens.groupBy("tok").agg(F.count("*").alias("n"))
    return counted.select("tok", F.array_join(F.coalesce(F.element_at(known, F.col("tok")), F.array(F.upper("tok"))), "|").alias("codes"), "n")


@query("SELECT c_custkey, n_name AS state, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return named.select("c_custkey", F.col("n_name").alias("state"), F.col("r_name").alias("region"))


@query("SELECT source, count(*) AS n, CAST(sum(CAST('0x' || substr(sha256(text), 1, 8) AS BIGINT)) AS BIGINT) AS digest_sum, max(sha256(text)) AS last_digest FROM documents GROUP BY source")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's content, whatever its order: sums over its texts' digests, so no text is ever gathered."""
    digests = table(spark, sf_dir, "documents").select("source", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    head = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    return digests.groupBy("source").agg(F.count("*").alias("n"), F.sum(head).alias("digest_sum"), F.max("digest").alias("last_digest"))
