"""Span extraction: where a pattern matches, in code points, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow import dims
from citeflow.functions.text import once, without_accents
from citeflow.operators.patterns import either

_LABELLED = rf"(?i)^(?:{either(dims.HEADER_LABELS)})\b|\bOAB\s*/"
_OPEN, _CLOSE, _FREE = "\x01", "\x02", "\x03"


def pieces(text: str | Column, pattern: str) -> Column:
    """array<string>: the text cut at the matches of a pattern without capturing groups; every other piece is a match."""
    clean = F.translate(F.col(text) if isinstance(text, str) else text, _OPEN + _CLOSE, _FREE + _FREE)
    return F.split(F.regexp_replace(clean, f"({pattern})", f"{_OPEN}$1{_CLOSE}"), f"[{_OPEN}{_CLOSE}]", -1)


def matches(text: str | Column, pattern: str) -> Column:
    """array<struct<start, end, snippet>> of the leftmost matches of a Java pattern without capturing groups.

    The matches are put between marks and the text is split at them; odd pieces are matches, and the lengths of the
    pieces before add up to their positions. For texts with few matches: the array is built match by match.
    """
    empty = F.expr("named_struct('at', 0, 'odd', false, 'out', CAST(array() AS array<struct<start: int, end: int, snippet: string>>))")

    def step(a: Column, p: Column) -> Column:
        end = a["at"] + F.length(p)
        found = F.struct(a["at"].alias("start"), end.alias("end"), p.alias("snippet"))
        return F.struct(end.alias("at"), (~a["odd"]).alias("odd"), F.when(a["odd"], F.array_append(a["out"], found)).otherwise(a["out"]).alias("out"))

    return F.aggregate(pieces(text, pattern), empty, step, lambda a: a["out"])


def regexp_spans(docs: DataFrame, keys: list[str], text: str, pattern: str, many: bool = False) -> DataFrame:
    """One row for each match: ``keys``, start, end, snippet. Texts without a match cost one scan and no split.

    ``many`` is for patterns that match all over (words): lengths of pieces are then summed up in a window over
    ``keys``, which must tell documents apart, instead of in one array.
    """
    hits = docs.where(F.col(text).rlike(pattern))
    if not many:
        return hits.select(*keys, F.inline(matches(text, pattern))).where(F.col("end") > F.col("start"))
    sized = F.transform(pieces(text, pattern), lambda p, i: F.struct(F.length(p).alias("size"), F.when(i % 2 == 1, p).alias("snippet")))
    rows = hits.select(*keys, F.posexplode(sized).alias("__i", "__piece")).select(*keys, "__i", "__piece.*")
    ends = F.sum("size").over(Window.partitionBy(*keys).orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    return rows.withColumn("end", ends).where("snippet IS NOT NULL AND size > 0").select(*keys, (F.col("end") - F.col("size")).alias("start"), "end", "snippet")


def all_matches(text: str, patterns: dict[str, str]) -> Column:
    """array<struct<start, end, snippet, form>> of several forms, in one pass over the text."""
    none = F.expr("CAST(array() AS array<struct<start: int, end: int, snippet: string, form: string>>)")

    def of(form: str, pattern: str) -> Column:
        named = F.transform(matches(text, pattern), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["snippet"].alias("snippet"), F.lit(form).alias("form")))
        return F.when(F.col(text).rlike(pattern), named).otherwise(none)

    return F.concat(*(of(form, pattern) for form, pattern in patterns.items()))


def multi_spans(docs: DataFrame, keys: list[str], text: str, patterns: dict[str, str]) -> DataFrame:
    """Several forms' spans, with the form's name; the documents are read once."""
    return docs.select(*keys, F.inline(all_matches(text, patterns))).where(F.col("end") > F.col("start"))


def header_end(text: str, labels: bool = False) -> Column:
    """Where the running text begins: after all first lines that are blank, all capitals, or short without small letters.

    With ``labels``, lines that begin with a header's label count as well.

    A text of header lines only ends where it ends; an empty one at 0.
    """
    lines = F.split(F.col(text), "(?<=\n)", -1)
    empty = F.expr("named_struct('at', 0, 'body', false)")

    def heads(bare: Column) -> Column:
        letters = F.length(F.regexp_replace(bare, "[^\\p{L}]", ""))
        small = bare.rlike("\\p{Ll}")
        labelled = without_accents(bare).rlike(_LABELLED) if labels else F.lit(False)
        return (bare == "") | (~small & ((F.length(bare) <= 40) | ((F.length(bare) <= 120) & (letters >= 3)))) | labelled

    def step(a: Column, line: Column) -> Column:
        bare = F.trim(F.translate(line, "\r\n\t", "   "))
        more = once(bare, heads)
        return F.when(a["body"], a).otherwise(once(more, lambda m: F.struct((a["at"] + F.when(m, F.length(line)).otherwise(0)).alias("at"), (~m).alias("body"))))

    return F.aggregate(lines, empty, step, lambda a: a["at"])
