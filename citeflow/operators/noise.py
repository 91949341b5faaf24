"""Noise as edit scripts: what a scan makes of a citation, with the original place of every character that is left.

An edit cuts ``cut`` characters at ``at`` and puts ``put`` there. Up to two edits are applied, in an order that a hash
gives; each is composed with the map of the ones before it, so the map always leads to the text that was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeflow.functions.text import once

#: Letters that stand for a digit after a scan.
LOOKALIKES = {"1": "lI", "0": "Oo", "5": "Ss", "9": "gG"}
MARKS = ["No", "n°", "N°", "n."]
LETTER = "[A-Za-zÀ-ÿ]"
MOST_EDITS = 2

State = Column


def drawn(modulus: int | Column, *keys: Column | str | int) -> Column:
    """A number from 0 below ``modulus`` that the keys give: the same in any engine with md5."""
    parts = (F.lit(str(k)) if isinstance(k, int) else F.col(k) if isinstance(k, str) else k for k in keys)
    number = F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("bigint")
    return number % modulus


def _edit(at: Column, cut: int, put: Column | str) -> Column:
    return F.when(at.isNotNull(), F.struct(at.cast("int").alias("at"), F.lit(cut).alias("cut"), (F.lit(put) if isinstance(put, str) else put).alias("put")))


def _char(text: Column, i: Column, n: int = 1) -> Column:
    """``n`` characters from place ``i`` on; none before the text begins."""
    return F.when(i < 0, "").otherwise(text.substr(i + 1, F.lit(n)))


def _places(text: Column, holds: Callable[[Column], Column]) -> Column:
    return F.filter(F.sequence(F.lit(0), F.length(text)), holds)


def _one(places: Column, draw: Column) -> Column:
    return once(places, lambda p: F.when(F.size(p) > 0, F.get(p, (draw % F.size(p)).cast("int"))))


def _among(options: list[str], draw: Column) -> Column:
    return F.get(F.array(*map(F.lit, options)), (draw % len(options)).cast("int"))


def _beside_letter(text: Column, i: Column, n: int) -> Column:
    return _char(text, i - 1).rlike(LETTER) | _char(text, i + n).rlike(LETTER)


def edits(text: Column, draw: Column) -> list[Column]:
    """What each kind of noise would do to ``text``; null where it can do nothing."""
    inside = r"[0-9./\-]"
    digit = _one(_places(text, lambda i: _char(text, i).isin(*LOOKALIKES) & (_char(text, i - 1).rlike(inside) | _char(text, i + 1).rlike(inside))), draw)
    like = F.create_map(*(F.lit(x) for k, v in LOOKALIKES.items() for x in (k, v)))
    letter = lambda at: F.element_at(like, _char(text, at)).substr((draw % 2 + 1).cast("int"), F.lit(1))
    gap = _one(_places(text, lambda i: _char(text, i - 2, 3).rlike(r"^[0-9][-.][0-9]$")), draw)
    mark = F.get(_places(text, lambda i: _char(text, i, 2).isin("nº", "n°", "n.") & ~_char(text, i - 1).rlike(LETTER)), 0)
    other = _among(MARKS, draw)
    dash = F.get(_places(text, lambda i: _char(text, i - 1, 3).rlike(r"^([0-9]-[0-9]| - )$")), 0)
    holding = F.get(_places(text, lambda i: F.lower(_char(text, i, 6)) == "súmula"), 0)
    m = _one(_places(text, lambda i: _char(text, i).isin("m", "M") & _beside_letter(text, i, 1)), draw)
    rn = _one(_places(text, lambda i: (F.lower(_char(text, i, 2)) == "rn") & _beside_letter(text, i, 2)), draw)
    return [
        once(digit, lambda at: _edit(at, 1, letter(at))),
        once(gap, lambda at: _edit(at, 0, " ")),
        once(gap, lambda at: _edit(at, 0, "\n")),
        once(mark, lambda at: F.when(_char(text, at, 2) != other, _edit(at, 2, other))),
        once(dash, lambda at: _edit(at, 1, "–")),
        once(holding, lambda at: _edit(at, 1, "5")),
        once(m, lambda at: _edit(at, 1, F.when(_char(text, at) == "M", "RN").otherwise("rn"))),
        once(rn, lambda at: _edit(at, 2, F.when(_char(text, at).isin("R"), "M").otherwise("m"))),
    ]


N_KINDS = 8


def applied(text: Column, places: Column, edit: Column) -> tuple[Column, Column]:
    """Text and map after an edit: a new character has the place of the one it replaces, or of the one before it."""
    at, cut, put = edit["at"], edit["cut"], edit["put"]
    new = F.transform(F.sequence(F.lit(1), F.length(put)), lambda j: F.element_at(places, F.greatest(at + F.least(j, cut), F.lit(1))))
    rest = F.filter(places, lambda _, i: i >= at + cut)
    return F.concat(text.substr(F.lit(1), at), put, text.substr(at + cut + 1, F.length(text))), F.concat(F.filter(places, lambda _, i: i < at), new, rest)


def noised(text: Column, *keys: Column | str | int, most: int = MOST_EDITS) -> Column:
    """struct<text, map, edits>: ``text`` after up to ``most`` edits, and for each character its place in ``text``."""
    order = F.transform(F.array_sort(F.array(*(F.struct(drawn(2**32, *keys, F.lit("order"), k).alias("by"), F.lit(k).alias("k"), drawn(2**31, *keys, F.lit("draw"), k).alias("draw")) for k in range(N_KINDS)))), lambda x: F.struct(x["k"].alias("k"), x["draw"].alias("draw")))
    start = F.struct(text.alias("text"), F.transform(F.sequence(F.lit(0), F.length(text) - 1), lambda i: i.cast("int")).alias("map"), F.lit(0).alias("edits"))

    def step(state: Column, kind: Column) -> Column:
        edit = F.lit(None).cast("struct<at: int, cut: int, put: string>")
        for k, e in reversed(list(enumerate(edits(state["text"], kind["draw"])))):
            edit = F.when(kind["k"] == k, e).otherwise(edit)
        once = F.transform(F.array(F.when(state["edits"] < most, edit)), lambda e: F.when(e.isNull(), state).otherwise(_after(state, e)))
        return F.get(once, 0)

    return F.aggregate(order, start, step)


def _after(state: Column, edit: Column) -> Column:
    text, places = applied(state["text"], state["map"], edit)
    return F.struct(text.alias("text"), places.alias("map"), (state["edits"] + 1).alias("edits"))
