"""Personal data by patterns, and by contexts learned from what the patterns find.

Base spans come from one regular expression for each kind. They are the seeds of a graph: on one side the contexts in
which values stand (the one or two words before, the word after), on the other the values. Unknown values are words
with a digit or an at-sign that no base span touches. Contexts are scored by the share of their occurrences that known
values make up, values by the contexts they stand in, in ``ROUNDS`` rounds; an unknown value whose score for a kind
reaches ``ACCEPT`` and whose digits fit the kind becomes a span of that kind. All of it is DataFrame expressions,
joins and sums; a frequent context or value meets others in map-side sums and in joins that Spark can split.

The expressions are the given ones with possessive repeats, and with the condition that a run of its first class is
entered at its start or right after a match: they match the same, but in linear time and without deep recursion.

Defined results: a null or empty text holds nothing (the digest is that of the empty string); positions are code
points; texts of any length are read whole; of spans that start at one place the kinds come as listed; rows are judged
one by one, repeated or not; an empty table gives no rows; further columns are ignored; rows with a null doc_id get
their base spans only. The control characters U+0001 and U+0002 count as U+0003, which is in no pattern either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import cut, shared_path

#: Kind, what a text must contain for it, its expression, and the test of a match ``p``.
_DIGITS = "length(regexp_replace(p, '[^0-9]', ''))"
KINDS = [
    ("email", "contains(text, '@')", r"(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", "true"),
    ("ip", "text RLIKE '[0-9][.][0-9]'", r"(?:(?<![0-9])|\\G)[0-9]++(?:\\.[0-9]++)(?:\\.[0-9]++)(?:\\.[0-9]++)", "forall(split(p, '[.]'), x -> length(trim(LEADING '0' FROM x)) <= 3 AND coalesce(CAST(right(x, 9) AS INT), 0) <= 255)"),
    ("card", "text RLIKE '[0-9][ -]?[0-9]'", r"[0-9](?:[ -]?[0-9])++", f"{_DIGITS} BETWEEN 12 AND 19 AND luhn_check(regexp_replace(p, '[^0-9]', ''))"),
    ("phone", "text RLIKE '[+][0-9]'", r"\\+[0-9][ ().0-9-]+[0-9]", f"{_DIGITS} BETWEEN 9 AND 15"),
]
#: Words that could be identifiers, and the shape that an unknown value of each kind must have.
_WORD = r"(?:(?<=[\\x09-\\x0D ])|^)[^\\x09-\\x0D 0-9@]*+[0-9@][^\\x09-\\x0D ]*+"
_SHAPES = {
    "email": "v RLIKE '^[^@]+(@|[(\\\\[]at[)\\\\]])[^@]+$'",
    "ip": "v RLIKE '^[0-9]{1,3}([.:,][0-9]{1,3}){2,3}$'",
    "card": "length(regexp_replace(v, '[^0-9]', '')) BETWEEN 12 AND 19 AND v RLIKE '^[0-9 -]+$'",
    "phone": "length(regexp_replace(v, '[^0-9]', '')) BETWEEN 7 AND 15 AND v RLIKE '^[+0-9().-]+$'",
}
ROUNDS = 3
ACCEPT = 0.9
LEAST_SEEDS = 3

_SPAN = "struct<k: int, s: int, e: int, v: string, l: string, r: string>"


def _found(kind: int, test: str) -> str:
    """Spans of the odd pieces of ``pieces`` that pass the test, with what stands before and after."""
    span = f"named_struct('k', {kind}, 's', a.at, 'e', a.at + length(p), 'v', p, 'l', right(get(pieces, a.i - 1), 80), 'r', left(get(pieces, a.i + 1), 40))"
    step = f"named_struct('at', a.at + length(p), 'i', a.i + 1, 'out', CASE WHEN a.i % 2 = 1 AND ({test}) THEN array_append(a.out, {span}) ELSE a.out END)"
    return f"aggregate(pieces, named_struct('at', 0, 'i', 0, 'out', CAST(array() AS array<{_SPAN}>)), (a, p) -> {step}, a -> a.out)"


def _marked(needs: str, pattern: str) -> str:
    return f"CASE WHEN {needs} THEN split(regexp_replace(text, '({pattern})', '\\u0001$1\\u0002'), '[\\u0001\\u0002]', -1) ELSE array() END"


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``text_key``, ``base`` (spans by start, then kind) and ``unknown`` (words outside of them)."""
    rows = docs.select(*keep, F.xxhash64(text).alias("text_key"), F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "\x03\x03").alias("text"))
    for k, (name, needs, pattern, test) in enumerate(KINDS):
        rows = rows.withColumn("pieces", F.expr(_marked(needs, pattern))).withColumn(name, F.expr(_found(k, test)))
    rows = rows.withColumn("pieces", F.expr(_marked("text RLIKE '[0-9@]'", _WORD))).withColumn("unknown", F.expr(_found(-1, "true")))
    base = F.array_sort(F.concat(*(n for n, *_ in KINDS)), lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["k"] - b["k"]))
    rows = rows.select(*keep, "text_key", base.alias("base"), "unknown")
    return rows.withColumn("unknown", F.expr("filter(unknown, u -> NOT exists(base, b -> b.s < u.e AND u.s < b.e))"))


def _contexts() -> Column:
    """The context patterns of an occurrence with ``l`` before and ``r`` after it."""
    plain = r"lower(regexp_replace({}, '[0-9]', '0'))"
    before, after = plain.format("l"), plain.format("r")
    two = f"regexp_extract({before}, '([^\\\\x09-\\\\x0D ]+[\\\\x09-\\\\x0D ]+[^\\\\x09-\\\\x0D ]+)[\\\\x09-\\\\x0D ]*$', 1)"
    one = f"regexp_extract({before}, '([^\\\\x09-\\\\x0D ]+)[\\\\x09-\\\\x0D ]*$', 1)"
    next_ = f"regexp_extract({after}, '^[\\\\x09-\\\\x0D ]*([^\\\\x09-\\\\x0D ]+)', 1)"
    return F.expr(f"filter(array(IF({two} = '', NULL, '2|' || {two}), IF({one} = '', NULL, '1|' || {one}), IF({one} = '' OR {next_} = '', NULL, '3|' || {one} || '|' || {next_})), x -> x IS NOT NULL)")


def _trimmed(v: str) -> str:
    return f"regexp_replace({v}, '^[(\\\\[\"<]+|[)\\\\]\">,;:.!?]+$', '')"


def discover(scanned: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, text_key, k, s, e of the spans that contexts show: accepted unknown values."""
    kinds = [n for n, *_ in KINDS]
    seeds = scanned.select(F.explode("base").alias("x")).select("x.k", "x.v", "x.l", "x.r").withColumn("seed", F.lit(1))
    words = scanned.select(F.explode("unknown").alias("x")).select(F.expr(_trimmed("x.v")).alias("v"), "x.l", "x.r")
    shape = " ".join(f"WHEN {_SHAPES[n]} THEN {k}" for k, n in enumerate(kinds))
    unknown = words.withColumn("k", F.expr(f"CASE {shape} ELSE -1 END")).select("k", "v", "l", "r").withColumn("seed", F.lit(0))
    edges = seeds.unionAll(unknown).withColumn("context", F.explode(_contexts()))
    edges = cut(edges.groupBy("context", "k", "v", "seed").agg(F.count("*").alias("n")))
    total = edges.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.when(F.col("seed") == 1, 1)).alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS).select("context", "total")
    edges = cut(edges.join(cut(total), "context"))
    known = edges.where("seed = 1").select("k", "context", F.col("n").cast("double").alias("mass"), "total")
    open_edges = edges.where("seed = 0 AND k >= 0").select("k", "context", "v", "n", "total")
    values: DataFrame | None = None
    for _ in range(ROUNDS):
        mass = known
        if values is not None:
            mass = mass.unionAll(open_edges.join(values, ["k", "v"]).select("k", "context", F.col("n") * F.col("score"), "total"))
        scored = cut(mass.groupBy("context", "k").agg(F.sum("mass").alias("mass"), F.max("total").alias("total")).select("context", "k", F.expr("mass / total * (total / (total + 1))").alias("precision")))
        doubt = F.log(1 - F.least("precision", F.lit(0.999)))
        values = cut(open_edges.join(scored, ["context", "k"]).groupBy("k", "v").agg(F.sum(doubt).alias("doubt")).select("k", "v", (1 - F.exp("doubt")).alias("score")))
    accepted = values.where(F.col("score") >= ACCEPT).select("k", "v")
    places = scanned.select(*keep, "text_key", F.explode("unknown").alias("x")).select(*keep, "text_key", "x.s", F.col("x.v").alias("word"), F.expr(_trimmed("x.v")).alias("v"))
    at = F.expr("s + locate(v, word) - 1")
    return places.where("v <> ''").join(accepted, "v").select(*keep, "text_key", "k", at.alias("s"), (at + F.length("v")).alias("e"))


def _written(spans: str) -> str:
    names = ", ".join(f"'{n}'" for n, *_ in KINDS)
    return f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({names}), x.k + 1), x.s, x.e)), ',')"


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of ``docs``."""
    spark = docs.sparkSession
    path = shared_path(spark, "pii-spans")
    scan(docs).write.parquet(path)
    scanned = spark.read.parquet(path)
    more = discover(scanned).where("doc_id IS NOT NULL").distinct()
    more = more.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("k", "s", "e")).alias("more"))
    slim = scanned.select("doc_id", "text_key", F.expr("transform(base, x -> named_struct('k', x.k, 's', x.s, 'e', x.e))").alias("base"))
    both = slim.join(more, ["doc_id", "text_key"], "left")
    every = F.array_sort(F.concat("base", F.coalesce("more", F.expr("filter(base, x -> false)"))), lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["k"] - b["k"]))
    counts = [F.expr(f"CAST(size(filter(base, x -> x.k = {k})) AS BIGINT)").alias(f"n_{n}") for k, (n, *_) in enumerate(KINDS)]
    return both.withColumn("every", every).select("doc_id", *counts, F.sha2(F.expr(_written("base")).cast("binary"), 256).alias("base_sha256"), F.expr(_written("every")).alias("spans"))
