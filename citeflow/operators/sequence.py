"""Sequences: sliding windows and their owners, BIO labels, islands, disjointness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.functions.intervals import touches, touching
from citeflow.operators.spans import matches, pieces

WINDOW, SHARED = 510, 128


def windows(n: Column, size: int = WINDOW, shared: int = SHARED) -> Column:
    """array<struct<start, end>>: windows of ``size`` with ``shared`` places in common; the last one ends at n."""
    step = size - shared
    k = F.when(n <= size, 1).otherwise(F.ceil((n - size) / step) + 1).cast("int")
    starts = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.greatest(F.least(i * step, n - size), F.lit(0)))
    return F.transform(starts, lambda s: F.struct(s.cast("int").alias("start"), F.least(s + size, n).cast("int").alias("end")))


def owned_ranges(spans: Column) -> Column:
    """array<struct<owner, first, last>>: the places that each window owns, in the sense of ``token_owner``, without listing places.

    Between two neighbouring windows ownership passes in the middle of what they share; windows that own nothing are left out.
    """

    def begins(i: Column) -> Column:
        before, own = F.get(spans, i - 1), F.get(spans, i)
        return F.when(i == 0, own["start"]).otherwise(F.floor((before["end"] - 1 + own["start"]) / 2) + 1).cast("long")

    last = F.size(spans) - 1
    ranges = F.transform(spans, lambda w, i: F.struct(i.alias("owner"), begins(i).alias("first"), (F.when(i == last, w["end"]).otherwise(begins(i + 1)) - 1).cast("long").alias("last")))
    return F.filter(ranges, lambda r: r["first"] <= r["last"])


def token_owner(token: Column, spans: Column) -> Column:
    """Index of the window in which a token is farthest from the edges; the first of equals."""

    def depth(w: Column) -> Column:
        inside = (token >= w["start"]) & (token < w["end"])
        return F.when(inside, F.least(token - w["start"], w["end"] - 1 - token)).otherwise(-1)

    depths = F.transform(spans, depth)
    return (F.array_position(depths, F.array_max(depths)) - 1).cast("int")


def bio_labels(tokens: DataFrame, spans: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Tokens (doc, token, start, end) with tag ``B-x``, ``I-x`` or ``O`` by the first span (start, end, label) they touch.

    Tokens and spans meet by document and bucket of positions; a token keeps one row.
    """
    s = spans.select(doc, F.col("start").alias("s_start"), F.col("end").alias("s_end"), "label")
    owned = touching(tokens, s, [doc], "start", "end", "s_start", "s_end").groupBy(doc, "token").agg(F.min(F.struct("s_start", "s_end", "label")).alias("own"))
    order = Window.partitionBy(doc).orderBy("token")
    before = F.lag("own").over(order)
    out = tokens.join(owned, [doc, "token"], "left").withColumn("before", before)
    tag = F.when(F.col("own").isNull(), "O").when(F.col("own").eqNullSafe(F.col("before")), F.concat(F.lit("I-"), F.col("own.label"))).otherwise(F.concat(F.lit("B-"), F.col("own.label")))
    return out.select(*tokens.columns, tag.alias("tag"))


def bio_labels_in_text(docs: DataFrame, text: str, word: str, span: str, around: str, label: str, doc: str = "doc_id") -> DataFrame:
    """doc, token, start, end, tag of the words of a text that touch a span, as ``bio_labels`` tags and numbers them.

    ``word`` and ``span`` are patterns; ``around`` matches the stretches outside of which no word touches a span, and which
    cut no word and no span. Only these stretches are cut into words; between them words are counted, so what is shuffled
    grows with the spans and not with the words. ``doc`` tells texts apart.
    """
    sized = F.transform(pieces(text, around), lambda p, i: F.struct(F.length(p).cast("long").alias("size"), F.regexp_count(p, F.lit(word)).cast("long").alias("words"), F.when(i % 2 == 1, p).alias("stretch")))
    rows = docs.where(F.col(text).rlike(span)).select(doc, F.posexplode(sized).alias("__i", "__piece")).select(doc, "__i", "__piece.*")
    before = Window.partitionBy(doc).orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
    sums = {c: F.coalesce(F.sum(n).over(before), F.lit(0)) for c, n in (("__at", "size"), ("__count", "words"))}
    stretches = rows.withColumns(sums).where("stretch IS NOT NULL").withColumn("__spans", matches("stretch", span))

    def own(w: Column) -> Column:
        return F.get(F.filter("__spans", lambda s: touches(s["start"], s["end"], w["start"], w["end"])), 0)["start"]

    tokens = F.transform(matches("stretch", word), lambda w, i: F.struct((F.col("__count") + i + 1).alias("token"), (F.col("__at") + w["start"]).cast("int").alias("start"), (F.col("__at") + w["end"]).cast("int").alias("end"), own(w).alias("own")))
    found = stretches.withColumn("__tokens", tokens)
    tag = lambda w, i: F.when(w["own"] == F.get("__tokens", i - 1)["own"], f"I-{label}").otherwise(f"B-{label}")
    tagged = F.transform("__tokens", lambda w, i: F.struct(w["token"].alias("token"), w["start"].alias("start"), w["end"].alias("end"), F.when(w["own"].isNotNull(), tag(w, i)).alias("tag")))
    return found.select(doc, F.inline(tagged)).where("tag IS NOT NULL")


def bio_decode(tags: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, start, end, label of the runs that begin at B (or at an I that continues nothing)."""
    order = Window.partitionBy(doc).orderBy("token")
    label = F.substring("tag", 3, 1000)
    marked = tags.withColumn("label", F.when(F.col("tag") != "O", label)).withColumn("before", F.lag("label").over(order))
    begins = F.col("label").isNotNull() & (F.col("tag").startswith("B-") | ~F.col("label").eqNullSafe(F.col("before")))
    runs = marked.withColumn("run", F.sum(begins.cast("int")).over(order)).where(F.col("label").isNotNull())
    return runs.groupBy(doc, "run", "label").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(doc, "start", "end", "label")


def islands(rows: DataFrame, keys: list[str], order_by: list[str], value: str) -> DataFrame:
    """Numbers the runs of equal ``value`` within ``keys``: column ``island``, from 1."""
    order = Window.partitionBy(*keys).orderBy(*order_by)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(order))) | (F.row_number().over(order) == 1)
    return rows.withColumn("__new", new.cast("int")).withColumn("island", F.sum("__new").over(order)).drop("__new")


def overlapping_neighbours(spans: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Spans that begin before the end of their predecessor."""
    order = Window.partitionBy(doc).orderBy("start", "end")
    return spans.withColumn("previous_end", F.lag("end").over(order)).where(F.col("start") < F.col("previous_end"))
