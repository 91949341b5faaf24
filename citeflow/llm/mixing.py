"""Mixing to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic, each with its tokens. The cells' weights are raked: for one
dimension after the other they are scaled so that the dimension's values get their target shares, ``ROUNDS`` times
over; ``gap`` tells how far the fitted weights are from the targets (where empty cells make targets contradict each
other, no weights meet them all). A document is then drawn
with the probability that its cell's weight over its cell's tokens asks for, scaled so that the largest is 1: in
expectation the sample has the raked shares. A draw depends on the id alone.

Everything is DataFrame expressions. Cells come from map-side sums over the documents; only cells, never documents,
are then summed up by a dimension's values, in windows (grouped sums that join the cells again were tried: they make
three jobs of one and took five times as long; a window holds the cells of one value, not its documents).
The fitted cells are a written table, so Spark knows their size and broadcasts them to the documents only below its
threshold.

Without given targets, a value's target share follows its tokens to the power ``POWER``, which lifts small values.
Without given topics they are learned from the texts: the ``TOPICS`` words held by the most documents, of those that
between a two-hundredth and a twentieth of all documents hold (of four letters or more), each stand for a topic, and a
document is of the one whose word it holds most often (of equals the rarer word's, then the first by name), or of none.

Defined results: a null or empty text has 0 tokens and the topic ``other``, and is drawn like its cell; texts of any
length are read whole; null sources, languages or topics form a value of their own; given targets need not add up to 1,
values without one keep their own share; cells without tokens keep probability 1; rows that share an id are drawn
together, and so are rows with a null id; repeated rows count each; an empty table gives none; further columns are kept
when rows are returned and ignored otherwise, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.llm.common import cut, unused, written

ROUNDS = 8
POWER = 0.95
TOPICS = 16
#: Topic words: the least length, and the shares of documents between which their frequency lies.
LEAST_LETTERS, RARE, COMMON = 4, 200, 20
DIMENSIONS = ("source", "lang", "topic")
NONE, OTHER = "(none)", "other"


def _words(text: str) -> Column:
    """The words of a text that may stand for a topic, each as often as it occurs."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, "[^\\p{L}]+"), lambda w: F.length(w) >= LEAST_LETTERS)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def topic_words(docs: DataFrame, text: str = "text") -> list[str]:
    """The words that stand for topics, the rarest first: at most ``TOPICS``."""
    held = docs.select(F.explode(F.array_distinct(_words(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    n = docs.count()
    chosen = held.where((F.col("n") * RARE >= n) & (F.col("n") * COMMON <= n)).orderBy(F.desc("n"), "word").limit(TOPICS).collect()
    return [r["word"] for r in sorted(chosen, key=lambda r: (r["n"], r["word"]))]


def learned_topic(words: list[str], text: str = "text") -> Column:
    """The topic of a text by ``words``, the rarest first."""
    if not words:
        return F.lit(OTHER)
    names = F.array(*map(F.lit, words))

    def most_held(counts: Column) -> Column:
        at = F.array_position(counts, F.array_max(counts)).cast("int")
        return F.when(F.array_max(counts) > 0, F.element_at(names, at)).otherwise(OTHER)

    def of(held: Column) -> Column:
        return _once(F.transform(names, lambda s: F.size(F.filter(held, lambda w: w == s))), most_held)

    return _once(F.filter(_words(text), lambda w: w.isin(words)), of)


def labelled(docs: DataFrame, topic: Column | None = None, keep: list[str] | None = None, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``keep`` columns (all) with those of the dictionary: tokens, source, lang, topic."""
    keep = docs.columns if keep is None else keep
    names = unused(docs.columns, "tokens", *DIMENSIONS)
    values = F.col("source"), F.col("lang"), learned_topic(topic_words(docs, text), text) if topic is None else topic
    words = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    labels = [F.coalesce(v, F.lit(NONE)).alias(names[d]) for d, v in zip(DIMENSIONS, values, strict=True)]
    return docs.select(*keep, words.alias(names["tokens"]), *labels), names


def _targets(cells: DataFrame, dimension: str, wanted: dict[str, float] | None) -> DataFrame:
    """The tokens that each value of a dimension is to have."""
    own = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("own"))
    every, powers = own.agg(F.sum("own"), F.sum(F.pow("own", F.lit(POWER)))).first()
    if not wanted:
        return own.select(dimension, (F.pow("own", F.lit(POWER)) / F.lit(powers) * F.lit(every)).alias("target"))
    target = F.col("own")
    for value, share in wanted.items():
        target = F.when(F.col(dimension) == value, F.lit(share / sum(wanted.values()) * (every or 0.0))).otherwise(target)
    return own.select(dimension, target.alias("target"))


def gap(fitted: DataFrame, wanted: dict[str, dict[str, float]] | None = None) -> float:
    """The largest relative distance of a value's share of the fitted weights from its target share."""
    worst, total = 0.0, fitted.agg(F.sum("weight")).first()[0] or 1.0
    for d in DIMENSIONS:
        now = fitted.groupBy(d).agg((F.sum("weight") / F.lit(total)).alias("now"))
        target = _targets(fitted, d, (wanted or {}).get(d))
        every = target.agg(F.sum("target")).first()[0] or 1.0
        far = now.join(target, d).where("target > 0").agg(F.max(F.abs(F.col("now") * F.lit(every) / F.col("target") - 1))).first()[0]
        worst = max(worst, far or 0.0)
    return worst


def fit(cells: DataFrame, wanted: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with weight and probability."""
    wanted = wanted or {}
    cells = written(cells, "mix-cells")
    targets = {d: written(_targets(cells, d, wanted.get(d)), "mix-targets") for d in DIMENSIONS}
    raked = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        raked = raked.join(targets[d].withColumnRenamed("target", f"{d}_target"), d)
    raked = cut(raked)
    for _ in range(rounds):
        for d in DIMENSIONS:
            now = F.sum("weight").over(Window.partitionBy(d))
            raked = raked.withColumn("now", now).withColumn("weight", F.expr(f"CASE WHEN now > 0 THEN weight * ({d}_target / now) ELSE 0 END"))
        raked = cut(raked.drop("now"))
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    largest = raked.agg(F.max(ratio)).first()[0]
    return written(raked.select(*DIMENSIONS, "tokens", "weight", F.coalesce(ratio / F.lit(largest), F.lit(1.0)).alias("probability")), "mix-fitted")


def _drawn(doc_id: str) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    digits = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 32)


def _with_probability(rows: DataFrame, names: dict[str, str], wanted: dict[str, dict[str, float]] | None) -> tuple[DataFrame, str]:
    keys = {d: names[d] for d in DIMENSIONS}
    cells = rows.groupBy(*(F.col(n).alias(d) for d, n in keys.items())).agg(F.sum(names["tokens"]).alias("tokens"))
    free = unused(rows.columns, "probability")["probability"]
    fitted = fit(cells, wanted).select(*(F.col(d).alias(n) for d, n in keys.items()), F.col("probability").alias(free))
    return rows.join(fitted, list(keys.values())), free


def mix(docs: DataFrame, wanted: dict[str, dict[str, float]] | None = None, topic: Column | None = None, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are drawn. ``wanted``: target shares by source, lang and topic."""
    drawn, free = _with_probability(*labelled(docs, topic), wanted)
    return drawn.where(_drawn(doc_id) < F.col(free)).select(*docs.columns)


def probabilities(docs: DataFrame) -> DataFrame:
    """doc_id, topic, n_tokens, probability (six decimals) and kept for every row of ``docs``."""
    rows, names = labelled(docs.select("doc_id", "text", "source", "lang"), keep=["doc_id"])
    drawn, free = _with_probability(written(rows, "mix-labels"), names, None)
    return drawn.select(
        "doc_id",
        F.col(names["topic"]).alias("topic"),
        F.col(names["tokens"]).alias("n_tokens"),
        F.round(free, 6).alias("probability"),
        (_drawn("doc_id") < F.col(free)).alias("kept"),
    )
