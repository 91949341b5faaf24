"""Spans in documents: extraction, overlaps, contracts, matching and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.functions.intervals import iou
from citeflow.functions.text import epoch_seconds
from citeflow.operators import overlap, spans, tagger
from citeflow.plans.catalog import query, table
from citeflow.sources.readers import parse_cells
from citeflow.sources.sinks import cells, violations

# The forms that stand in for citations here, by how specific they are.
PATTERNS = {
    "com_numero": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z0-9.-]+",
    "sumula": "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+",
    "lei_artigo": "[0-9]{3,}",
    "sem_numero": "[0-9][0-9 .()-]+[0-9]",
}


def _marked(pattern: str, source: str = "documents") -> str:
    """SQL for the spans of one pattern: mark, split, and add up the lengths before."""
    return f"""SELECT doc_id, CAST(start AS INTEGER) AS start, CAST(start + len(x) AS INTEGER) AS "end", x AS snippet FROM (
      SELECT doc_id, i, x, coalesce(sum(len(x)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS x FROM (
        SELECT doc_id, string_split(replace(regexp_replace(text, '({pattern})', chr(1) || '\\1' || chr(2), 'g'), chr(2), chr(1)), chr(1)) AS p FROM {source}))
    ) WHERE i % 2 = 0 AND len(x) > 0"""


_MULTI = " UNION ALL ".join(f"SELECT *, '{form}' AS form FROM ({_marked(p)})" for form, p in PATTERNS.items())


@query(_marked("[0-9]+"))
def number_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.regexp_spans(table(spark, sf_dir, "documents"), ["doc_id"], "text", "[0-9]+")


@query(_MULTI)
def multi_pattern_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.multi_spans(table(spark, sf_dir, "documents"), ["doc_id"], "text", PATTERNS)


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_pattern_spans(spark, sf_dir).withColumn("origins", F.array(F.lit("regex")))


# Ranks as in the schema; a kept span is one that no better one contains or half covers, found by recursion over the order.
_RANKED = f"""ranked AS (
  SELECT doc_id, start, "end", form, row_number() OVER (PARTITION BY doc_id ORDER BY CASE form WHEN 'com_numero' THEN -3 WHEN 'sumula' THEN -2 WHEN 'lei_artigo' THEN -1 ELSE 0 END, start - "end", start) AS k
  FROM ({_MULTI})
)"""


@query(f"""
WITH RECURSIVE {_RANKED}, fold AS (
  SELECT doc_id, 0 AS k, CAST([] AS STRUCT(s INTEGER, e INTEGER, f VARCHAR)[]) AS kept FROM (SELECT DISTINCT doc_id FROM ranked)
  UNION ALL
  SELECT r.doc_id, CAST(r.k AS INTEGER), CASE
      WHEN len(list_filter(fold.kept, lambda y: r.start >= y.s AND r."end" <= y.e AND (r.start <> y.s OR r."end" <> y.e))) > 0
        OR len(list_filter(fold.kept, lambda y: NOT (y.s >= r.start AND y.e <= r."end" AND (r.start <> y.s OR r."end" <> y.e)) AND least(y.e, r."end") > greatest(y.s, r.start)
             AND 2 * (least(y.e, r."end") - greatest(y.s, r.start)) >= (y.e - y.s) + (r."end" - r.start) - (least(y.e, r."end") - greatest(y.s, r.start)))) > 0 THEN fold.kept
      ELSE list_append(list_filter(fold.kept, lambda y: NOT (y.s >= r.start AND y.e <= r."end" AND (r.start <> y.s OR r."end" <> y.e))), CAST(struct_pack(s := r.start, e := r."end", f := r.form) AS STRUCT(s INTEGER, e INTEGER, f VARCHAR))) END
  FROM fold JOIN ranked AS r ON r.doc_id = fold.doc_id AND r.k = fold.k + 1
), last AS (SELECT doc_id, max(k) AS k FROM fold GROUP BY doc_id)
SELECT doc_id, x.s AS start, x.e AS "end", x.f AS form FROM (SELECT fold.doc_id, unnest(kept) AS x FROM fold JOIN last ON fold.doc_id = last.doc_id AND fold.k = last.k)
""")
def overlap_resolved_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.resolve_overlaps(_mentions(spark, sf_dir)).select("doc_id", "start", "end", "form")


@query(f"""
SELECT s.doc_id, s.start, s."end", substr(d.text, s.start + 1, s."end" - s.start) = s.snippet AS same FROM ({_marked("[0-9]+")}) AS s JOIN documents AS d ON s.doc_id = d.doc_id
""")
def span_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span against its text, through the contract rules: none is broken."""
    docs = table(spark, sf_dir, "documents")
    found = number_spans(spark, sf_dir)
    verified = found.select("doc_id", "start", "end", "snippet", F.lit("sumula").alias("form"), F.lit("jurisprudencia").alias("type"), F.lit("incompleta").alias("verdict"), F.lit(None).cast("string").alias("canonical_id"), F.lit(0.5).alias("confidence"))
    broken = violations(verified, docs).select("doc_id", "start", "end", F.lit(True).alias("broken")).distinct()
    return found.join(broken, ["doc_id", "start", "end"], "left").select("doc_id", "start", "end", F.col("broken").isNull().alias("same"))


@query(f"""
WITH l AS (SELECT doc_id, strpos(text, chr(10)) AS body FROM documents)
SELECT s.doc_id, s.start, s."end" FROM ({_marked("[0-9]+")}) AS s JOIN l ON s.doc_id = l.doc_id WHERE s.start >= l.body
""")
def body_only_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans that begin after the first line."""
    docs = table(spark, sf_dir, "documents").withColumn("body", F.instr("text", "\n"))
    return spans.regexp_spans(docs, ["doc_id", "body"], "text", "[0-9]+").where(F.col("start") >= F.col("body")).select("doc_id", "start", "end")


@query(f"""
WITH s AS ({_marked("[0-9]+")}), c AS (
  SELECT doc_id, string_agg(start || ',' || "end" || ',incompleta,-,' || CASE WHEN start % 2 = 0 THEN '0.5000' ELSE '-' END, '|' ORDER BY start, "end") AS cells FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(cells, '-') AS cells FROM documents AS d LEFT JOIN c ON d.doc_id = c.doc_id
""")
def submission_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = number_spans(spark, sf_dir).withColumn("verdict", F.lit("incompleta")).withColumn("canonical_id", F.lit(None).cast("string"))
    return cells(table(spark, sf_dir, "documents"), found.withColumn("confidence", F.when(F.col("start") % 2 == 0, 0.5)))


@query(f"SELECT doc_id, start, \"end\", 'incompleta' AS verdict, CASE WHEN start % 2 = 0 THEN 0.5 END::DOUBLE AS confidence FROM ({_marked('[0-9]+')})")
def submission_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_cells(submission_cells(spark, sf_dir)).select("doc_id", "start", "end", "verdict", "confidence")


_EVENTS = """e AS (SELECT user_id AS doc_id, event_id AS id, event_type, CAST(floor(epoch(ts)) AS BIGINT) % 5000 AS start, CAST(floor(epoch(ts)) AS BIGINT) % 5000 + 400 + event_id % 300 AS "end" FROM events),
g AS (SELECT * FROM e WHERE id % 2 = 0), p AS (SELECT * FROM e WHERE id % 2 = 1)"""


@query(f"""
WITH {_EVENTS}, c AS (
  SELECT a.doc_id, a.id AS a_id, b.id AS b_id, least(a."end", b."end") - greatest(a.start, b.start) AS c, (a."end" - a.start) + (b."end" - b.start) AS s
  FROM e AS a JOIN e AS b ON a.doc_id = b.doc_id AND a.id < b.id AND a.start < b."end" AND b.start < a."end"
)
SELECT doc_id, a_id, b_id, round(c / CAST(s - c AS DOUBLE), 6) AS iou FROM c
""")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _intervals(spark, sf_dir)
    a = e.select("doc_id", F.col("id").alias("a_id"), F.col("start").alias("a_start"), F.col("end").alias("a_end"))
    b = e.select("doc_id", F.col("id").alias("b_id"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    touching = (F.col("a_id") < F.col("b_id")) & (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
    share = iou(F.col("a_start"), F.col("a_end"), F.col("b_start"), F.col("b_end"))
    return a.join(b, "doc_id").where(touching).select("doc_id", "a_id", "b_id", F.round(share, 6).alias("iou"))


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = epoch_seconds(F.col("ts")) % 5000
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("id"), at.alias("start"), (at + 400 + F.col("event_id") % 300).alias("end"), "event_type")


@query(f"""
WITH {_EVENTS}
SELECT p.doc_id, p.id FROM p WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = p.doc_id AND p.start < g."end" AND g.start < p."end")
""")
def interval_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _intervals(spark, sf_dir)
    return overlap.outside_of(e.where("id % 2 = 1"), e.where("id % 2 = 0")).select("doc_id", "id")


_PAIRS = f"""{_EVENTS}, pair AS (
  SELECT g.doc_id, g.id AS gold_id, p.id AS found_id, g.start AS g_start, p.start AS p_start, least(g."end", p."end") - greatest(g.start, p.start) AS c, (g."end" - g.start) + (p."end" - p.start) AS s
  FROM g JOIN p ON g.doc_id = p.doc_id AND g.start < p."end" AND p.start < g."end"
), good AS (SELECT doc_id, gold_id, found_id, g_start, p_start, c / CAST(s - c AS DOUBLE) AS iou FROM pair WHERE 2 * c >= s - c)"""


def _greedy(order: str) -> str:
    return f"""
WITH RECURSIVE {_PAIRS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY {order}) AS k FROM good), fold AS (
  SELECT doc_id, 0 AS k, CAST([] AS BIGINT[]) AS gs, CAST([] AS BIGINT[]) AS ps FROM (SELECT DISTINCT doc_id FROM ranked)
  UNION ALL
  SELECT r.doc_id, CAST(r.k AS INTEGER), CASE WHEN list_contains(gs, gold_id) OR list_contains(ps, found_id) THEN gs ELSE list_append(gs, gold_id) END,
         CASE WHEN list_contains(gs, gold_id) OR list_contains(ps, found_id) THEN ps ELSE list_append(ps, found_id) END
  FROM fold JOIN ranked AS r ON r.doc_id = fold.doc_id AND r.k = fold.k + 1
), last AS (SELECT doc_id, max(k) AS k FROM fold GROUP BY doc_id),
m AS (SELECT fold.doc_id, unnest(gs) AS gold_id, unnest(ps) AS found_id FROM fold JOIN last ON fold.doc_id = last.doc_id AND fold.k = last.k)"""


@query(_greedy("-iou, g_start, p_start, gold_id, found_id") + "\nSELECT m.doc_id, m.gold_id, m.found_id, round(iou, 6) AS iou FROM m JOIN good ON m.gold_id = good.gold_id AND m.found_id = good.found_id")
def greedy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _intervals(spark, sf_dir)
    return overlap.match_one_to_one(e.where("id % 2 = 0"), e.where("id % 2 = 1")).select("doc_id", "gold_id", "found_id", F.round("iou", 6).alias("iou"))


@query(_greedy("g_start, -iou, p_start, gold_id, found_id") + """
, a AS (SELECT doc_id, id, event_type AS label FROM g), b AS (SELECT doc_id, id, event_type AS label FROM p)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.id IS NULL THEN 'appeared' WHEN b.id IS NULL THEN 'gone' WHEN a.label = b.label THEN 'same' ELSE 'changed' END AS change, coalesce(CAST(a.id AS VARCHAR), '-') AS a_id, coalesce(CAST(b.id AS VARCHAR), '-') AS b_id
FROM a LEFT JOIN m ON a.id = m.gold_id FULL JOIN b ON m.found_id = b.id
""")
def run_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _intervals(spark, sf_dir).withColumn("label", F.col("event_type")).withColumn("target", F.lit(None).cast("string"))
    found = overlap.run_difference(e.where("id % 2 = 0"), e.where("id % 2 = 1"))
    return found.select("doc_id", "change", *(F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in ("a_id", "b_id")))


@query(f"""
WITH {_EVENTS}
SELECT g.doc_id, g.start, g."end", bool_or(coalesce(p.start < g."end" AND g.start < p."end", false)) AS touched,
       bool_or(coalesce(p.start < g."end" AND g.start < p."end" AND 2 * (least(g."end", p."end") - greatest(g.start, p.start)) >= (g."end" - g.start) + (p."end" - p.start) - (least(g."end", p."end") - greatest(g.start, p.start)), false)) AS half
FROM g LEFT JOIN p ON g.doc_id = p.doc_id GROUP BY g.doc_id, g.start, g."end"
""")
def span_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _intervals(spark, sf_dir)
    return tagger.recall(e.where("id % 2 = 0"), e.where("id % 2 = 1"))


@query(f"""
WITH {_EVENTS}
SELECT DISTINCT p.doc_id, p.id FROM p JOIN g ON g.doc_id = p.doc_id WHERE 10 * greatest(least(g."end", p."end") - greatest(g.start, p.start), 0) >= 9 * (p."end" - p.start)
""")
def forgiven_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _intervals(spark, sf_dir).select("doc_id", "id", "start", "end")
    return tagger.forgiven(e.where("id % 2 = 0"), e.where("id % 2 = 1")).select("doc_id", "id")


@query(f"""
WITH {_EVENTS}, k AS (SELECT * FROM p WHERE id % 10 <> 1 AND NOT EXISTS (SELECT 1 FROM e AS i WHERE i.id % 10 = 1 AND i.doc_id = p.doc_id AND p.start < i."end" AND i.start < p."end")),
m AS (SELECT g.event_type AS label, g.doc_id, g.start AS gs, g."end" AS ge, k.start AS ps, k."end" AS pe FROM g JOIN k ON g.doc_id = k.doc_id AND g.event_type = k.event_type AND g.start < k."end" AND k.start < g."end"
  AND 2 * (least(g."end", k."end") - greatest(g.start, k.start)) >= (g."end" - g.start) + (k."end" - k.start) - (least(g."end", k."end") - greatest(g.start, k.start)))
SELECT l.label, (SELECT count(*) FROM g WHERE event_type = l.label) AS gold, (SELECT count(DISTINCT (doc_id, gs, ge)) FROM m WHERE m.label = l.label) AS matched,
       (SELECT count(*) FROM k WHERE event_type = l.label) AS predicted, (SELECT count(DISTINCT (doc_id, ps, pe)) FROM m WHERE m.label = l.label) AS correct
FROM (SELECT DISTINCT event_type AS label FROM e) AS l
""")
def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _intervals(spark, sf_dir).withColumn("label", F.col("event_type"))
    ignored = e.where("id % 10 = 1")
    return tagger.tag_counts(e.where("id % 2 = 0"), e.where("id % 2 = 1 AND id % 10 <> 1"), ignored)
