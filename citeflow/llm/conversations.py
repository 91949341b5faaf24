"""Conversation structure repair by dynamic programming over a grammar of the conversations' symbols.

A row is one letter, of its role's initial and its fault; a conversation is a string of them. Equal strings are repaired
once, however many conversations share them. Re-Pair replaces pairs of symbols that are frequent over all distinct strings
by rules, a Spark job a round. A symbol's transfer matrix has, for each state before and after it, the least cost and the
audit that belongs to it; a rule's matrix is the min-plus product of its two symbols' matrices, so each is evaluated once,
bottom-up. Audits are ropes: a rule's audit is a pair of references, and a whole one is only spelled for a whole string.

States of what was written so far: nothing, a system row, a user row last, an assistant row last. Equal costs are decided by
the audit, ASCII-least: of two audits of one cost between the same states none begins the other (the longer would hold
further inserts, which cost), so the least of a product is made of the least of its factors.

Defined results. A null id is a conversation of its own; null turns come first; equal turns are ordered by role, then text.
Nulls in role or text are one space, so such a text is blank and goes. A role counts by its first character, and one of
another initial, or none, can be reroled or deleted. Repeated rows are duplicates. No rows: zeros, an empty audit, the hash of the
empty string. Further columns are left out. ``gaps`` is null where it doesn't fit 63 bits.

The rows of a conversation are sorted and streamed, never held: in memory a conversation has one letter a row, as its audit
has. SHA-256 reads a text in order, so a conversation's text passes through one task; that is the result asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.llm.common import slices, unused, written

#: Letters of rows: initials of roles (x: any other), upper case if truncated; a row that has to go.
GONE = "-"
LETTERS = "suaxSUAX" + GONE
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: A pair becomes a rule if it occurs so often in distinct strings; rules of one round, and in all (what is sent to tasks).
LEAST_COUNT, BATCH, MOST_RULES = 8, 256, 8192
BLOCK = 4096
BLANKS = r"\x20\x09-\x0D"


# ---- faults -------------------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults that crc32 of ``conv_id:turn`` asks for; nulls are one space."""
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", as_text("conv_id"), as_text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _plain(rows: DataFrame) -> DataFrame:
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    return rows.select("conv_id", "turn", as_text("role"), as_text("text"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def summaries(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, letters: one row a conversation that has rows."""
    along = Window.partitionBy("conv_id").orderBy(*_order())
    last = F.substring(F.regexp_replace("text", rf"[{BLANKS}]+\z", ""), -1, 1)
    initial = F.substring("role", 1, 1)
    marked = (
        _plain(rows)
        .withColumn("blank", ~F.col("text").rlike(f"[^{BLANKS}]"))
        .withColumn("again", F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1)
        .withColumn("at", F.row_number().over(along))
        .withColumn("pair", F.concat(F.lag(initial).over(along), initial))
        .withColumn("before", F.lag("turn").over(along))
        .withColumn("duplicate", F.col("again") & ~F.col("blank"))
        .withColumn("truncated", ~F.col("blank") & ~F.col("again") & ~last.isin(".", "!", "?"))
        .withColumn("letter", F.when(initial.isin("s", "u", "a"), initial).otherwise("x"))
        .withColumn("letter", F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), F.upper("letter")).otherwise(F.col("letter")))
    )
    count = lambda c: F.sum(c.cast("long"))
    blocks = marked.groupBy("conv_id", F.floor((F.col("at") - 1) / BLOCK).alias("block")).agg(
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        count(F.coalesce(F.col("turn") != F.col("before"), F.col("turn").isNotNull())).alias("turns"),
        *(count(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")),
        count(F.col("pair").isNotNull() & ~F.coalesce(F.col("pair"), F.lit("")).isin("su", "ua", "au")).alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "letter"))), lambda x: x["letter"]), "").alias("letters"),
    )
    whole = blocks.groupBy("conv_id").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("turns").alias("turns"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "letters"))), lambda x: x["letters"]), "").alias("letters"),
    )
    gaps = F.expr("coalesce(high::decimal(20,0) - low::decimal(20,0) + 1 - turns, 0)")
    return whole.select("conv_id", gaps.try_cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "letters")


# ---- grammar ------------------------------------------------------------------------------------------------------


def _replaced(symbols: list[int], rules: dict[tuple[int, int], int]) -> list[int]:
    """Each pair that has a rule replaced, from left to right."""
    out, i, n = [], 0, len(symbols)
    while i < n:
        rule = rules.get((symbols[i], symbols[i + 1])) if i + 1 < n else None
        out.append(symbols[i] if rule is None else rule)
        i += 1 if rule is None else 2
    return out


def grammar(strings: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The distinct strings as (letters, symbols), and the rules: symbol len(LETTERS) + k stands for the pair rules[k].

    Each round takes the most frequent pairs, of which none ends with a symbol that another begins with, so that no two can
    overlap; it ends when no pair is frequent. A string that still has many symbols then is only dearer to evaluate.
    """
    codes = f"transform(split(letters, ''), c -> locate(c, '{LETTERS}') - 1) AS symbols"
    table, rules = written(strings.select("letters").distinct().where("letters <> ''").selectExpr("letters", codes), "repair-strings"), []
    while len(rules) < MOST_RULES:
        pairs = table.where("size(symbols) > 1").selectExpr("explode(transform(sequence(0, size(symbols) - 2), i -> struct(symbols[i] AS a, symbols[i + 1] AS b))) AS p")
        frequent = pairs.groupBy("p.a", "p.b").count().where(F.col("count") >= LEAST_COUNT).orderBy(F.desc("count"), "a", "b").limit(min(BATCH, MOST_RULES - len(rules))).collect()
        if not frequent:
            break
        firsts, seconds, chosen = set(), set(), {}
        for a, b, _ in frequent:
            if a in seconds or b in firsts:
                continue
            firsts.add(a)
            seconds.add(b)
            chosen[a, b] = len(LETTERS) + len(rules)
            rules.append((a, b))

        def rewritten(batches: Iterator[pa.RecordBatch], chosen=chosen) -> Iterator[pa.RecordBatch]:
            for piece in slices(batches):
                new = pa.array([_replaced(s, chosen) for s in piece.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([piece.column(0), new], ["letters", "symbols"])

        table = written(table.mapInArrow(rewritten, "letters string, symbols array<int>"), "repair-strings")
    return table, rules


# ---- transfer matrices --------------------------------------------------------------------------------------------


class Audits:
    """Audits as ropes: each is a number; equal texts joined in equal parts are the same number."""

    def __init__(self) -> None:
        self.parts: list[str | tuple[int, int]] = [""]
        self.sizes = [0]
        self.known: dict[str | tuple[int, int], int] = {"": 0}

    def of(self, parts: str | tuple[int, int]) -> int:
        if isinstance(parts, tuple) and not (self.sizes[parts[0]] and self.sizes[parts[1]]):
            return parts[0] or parts[1]
        at = self.known.get(parts)
        if at is None:
            at = self.known[parts] = len(self.parts)
            self.parts.append(parts)
            self.sizes.append(len(parts) if isinstance(parts, str) else self.sizes[parts[0]] + self.sizes[parts[1]])
        return at

    def text(self, at: int) -> str:
        out, stack = [], [at]
        while stack:
            part = self.parts[stack.pop()]
            if isinstance(part, str):
                out.append(part)
            else:
                stack += [part[1], part[0]]
        return "".join(out)

    def less(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` is ASCII-less than that of ``b``; shared parts are skipped, not spelled."""
        left, right = [(a, 0)], [(b, 0)]  # what is still to compare, and how much of its text is done
        while left and right:
            (x, i), (y, j) = left.pop(), right.pop()
            if x == y and i == j:
                continue
            p, q = self.parts[x], self.parts[y]
            if not isinstance(p, str) and (isinstance(q, str) or self.sizes[x] >= self.sizes[y]):
                right.append((y, j))
                left += [(p[1], 0), (p[0], 0)]
            elif not isinstance(q, str):
                left.append((x, i))
                right += [(q[1], 0), (q[0], 0)]
            else:
                n = min(len(p) - i, len(q) - j)
                s, t = p[i : i + n], q[j : j + n]
                if s != t:
                    return s < t
                left += [(x, i + n)] if i + n < len(p) else []
                right += [(y, j + n)] if j + n < len(q) else []
        return bool(right) and not left


#: A matrix: for each pair of states that it joins, cost and audit.
Matrix = dict[tuple[int, int], tuple[int, int]]


def _least(audits: Audits, old: tuple[int, int] | None, new: tuple[int, int]) -> tuple[int, int]:
    if old is None or new[0] < old[0] or (new[0] == old[0] and audits.less(new[1], old[1])):
        return new
    return old


def product(audits: Audits, left: Matrix, right: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, m), (cost, audit) in left.items():
        for (k, j), (more, rest) in right.items():
            if k == m and ((i, j) not in out or cost + more <= out[i, j][0]):
                out[i, j] = _least(audits, out.get((i, j)), (cost + more, audits.of((audit, rest))))
    return out


def inserts(audits: Audits) -> Matrix:
    """Any rows put in at one place; a user row and an assistant row reach every state that can be reached."""
    one, two = (INSERT, audits.of("I")), (2 * INSERT, audits.of("II"))
    out: Matrix = {(i, i): (0, 0) for i in range(4)}
    return out | {(START, USER): one, (SYSTEM, USER): one, (ASSISTANT, USER): one, (USER, ASSISTANT): one, (START, ASSISTANT): two, (SYSTEM, ASSISTANT): two}


def edits(audits: Audits, letter: str) -> Matrix:
    """One row kept, reroled or deleted."""
    out: Matrix = {(i, i): (DELETE, audits.of("D")) for i in range(4)}
    if letter == GONE:
        return out
    stays = TRUNCATED if letter.isupper() else 0
    moves = {"s": [(START, SYSTEM)], "u": [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)], "x": []}
    for move in moves["u"] + moves["a"]:
        out[move] = _least(audits, out.get(move), (REROLE + stays, audits.of("R")))
    for move in moves[letter.lower()]:
        out[move] = _least(audits, out.get(move), (KEEP + stays, audits.of("K")))
    return out


class Repairs:
    """The matrices of all symbols, rules bottom-up; made once and sent to the tasks."""

    def __init__(self, rules: list[tuple[int, int]]) -> None:
        self.audits = Audits()
        self.inserted = inserts(self.audits)
        self.matrices = [product(self.audits, self.inserted, edits(self.audits, c)) for c in LETTERS]
        for a, b in rules:
            self.matrices.append(product(self.audits, self.matrices[a], self.matrices[b]))

    def of(self, symbols: list[int]) -> tuple[int, str]:
        """Cost and audit of the cheapest repair of a whole string."""
        audits = self.audits
        size = len(audits.parts)
        now: Matrix = {(START, START): (0, 0)}
        for s in symbols:
            now = product(audits, now, self.matrices[s])
        now = product(audits, now, self.inserted)
        best = None
        for end in (START, ASSISTANT):
            if (START, end) in now:
                best = _least(audits, best, now[START, end])
        found = best[0], audits.text(best[1])
        for part in audits.parts[size:]:  # a string's own ropes are not needed again
            del audits.known[part]
        del audits.parts[size:], audits.sizes[size:]
        return found


def string_repairs(strings: DataFrame) -> DataFrame:
    """letters, cost, audit for each distinct string."""
    table, rules = grammar(strings)
    repairs = Repairs(rules)

    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found = [repairs.of(s) for s in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], ["letters", "cost", "audit"])

    return table.mapInArrow(evaluated, "letters string, cost bigint, audit string")


# ---- repaired rows ------------------------------------------------------------------------------------------------


def plans(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """For each id of ``conversations`` its summary, cost and audit; ids without rows have zeros and an empty audit."""
    found = written(summaries(rows), "repair-summaries")
    each = found.join(string_repairs(found), "letters", "left").drop("letters")
    ids = conversations.select("conv_id").distinct()
    n = unused(each.columns, "id")["id"]
    return (
        ids.join(each.withColumnRenamed("conv_id", n), F.col("conv_id").eqNullSafe(F.col(n)), "left")
        .drop(n)
        .select("conv_id", "gaps", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.col("audit").isNull().alias("none"))
        .withColumn("gaps", F.when(F.col("none"), F.lit(0)).otherwise(F.col("gaps")))
        .drop("none")
    )


def _ordered(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's plan before its rows, in order, in one partition; ``role`` of a plan is its audit."""
    kind = rows.schema["turn"].dataType.simpleString()
    heads = found.selectExpr("conv_id", "struct(gaps, blank, duplicate, truncated, illegal, cost) AS plan", f"CAST(NULL AS {kind}) AS turn", "audit AS role", "CAST(NULL AS string) AS text")
    none = "CAST(NULL AS struct<gaps: bigint, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, cost: bigint>) AS plan"
    both = heads.unionByName(_plain(rows).selectExpr("conv_id", none, "turn", "role", "text"))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("plan").isNull(), *_order())


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, plan, audit, None, None) where a conversation begins, then (conv_id, edit, turn, role, text) for each row that stays."""
    audit, at, last = "", 0, ""
    conv = None

    def put_in(conv):
        nonlocal at, last
        while at < len(audit) and audit[at] == "I":
            at += 1
            last = "assistant" if last == "u" else "user"
            row = (conv, "I", None, last, "")
            last = last[0]
            yield row

    for piece in slices(batches):
        columns = [piece.column(k).to_pylist() for k in range(5)]
        for this, plan, turn, role, text in zip(*columns, strict=True):
            if plan is not None:
                yield from put_in(conv)
                conv, audit, at, last = this, role, 0, ""
                yield conv, plan, audit, None, None
                continue
            yield from put_in(conv)
            edit = audit[at]
            at += 1
            if edit == "R":
                role = "assistant" if last == "u" else "user"
            if edit != "D":
                last = role[:1]
                yield conv, edit, turn, role, text
    yield from put_in(conv)


def repaired_rows(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 1), edit (K, R or I), turn, role, text."""
    ordered = _ordered(rows, plans(rows, conversations))
    fields = ordered.schema
    schema = f"conv_id {fields['conv_id'].dataType.simpleString()}, place bigint, edit string, turn {fields['turn'].dataType.simpleString()}, role string, text string"

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None

        def batch(held: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "edit", "turn", "role", "text"])

        def seen():
            nonlocal types
            for b in batches:
                types = types or [b.schema.field(0).type, pa.int64(), pa.string(), b.schema.field(2).type, pa.string(), pa.string()]
                yield b

        held, place = [], 0
        for conv, edit, turn, role, text in _edited(seen()):
            if isinstance(edit, dict):
                place = 0
                continue
            place += 1
            held.append((conv, place, edit, turn, role, text))
            if len(held) == 1024:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    return ordered.mapInArrow(out, schema)


def digests(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row a conversation of ``conversations``: its faults, the repair's cost and audit, and the hash of what it gives."""
    ordered = _ordered(rows, plans(rows, conversations))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, {', '.join(f'{n} bigint' for n in names)}, audit string, repaired_sha256 string"

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def seen():
            nonlocal kind
            for b in batches:
                kind = kind or b.schema.field(0).type
                yield b

        def batch(held: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            arrays = [pa.array(columns[0], kind), *(pa.array([p[n] for p in columns[1]], pa.int64()) for n in names), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *names, "audit", "repaired_sha256"])

        held, now, digest, empty = [], None, None, True
        for conv, edit, turn, role, text in _edited(seen()):
            if isinstance(edit, dict):
                if now:
                    held.append((*now, digest.hexdigest()))
                    if len(held) == 1024:
                        yield batch(held)
                        held = []
                now, digest, empty = (conv, edit, turn), hashlib.sha256(), True
                continue
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
        if now:
            held.append((*now, digest.hexdigest()))
        if held:
            yield batch(held)

    return ordered.mapInArrow(out, schema)
