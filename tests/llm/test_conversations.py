import hashlib
import itertools
import zlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from citeflow.llm import conversations, oracles, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, audit int"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_equals_the_recursion_in_sql(spark, sf):
    got = queries.op13_conversations(spark, sf)
    assert got.columns == COLUMNS
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.sql(oracles.op13()).select(*COLUMNS).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def _spelled(rows):
    """cost, audit and repaired rows of the cheapest edits, by trying all; rows are (role, text, gone, extra)."""
    best = None
    for fill in itertools.product(range(3), repeat=len(rows) + 1):
        for kinds in itertools.product("KRD", repeat=len(rows)):
            cost, audit, roles, out = 0, "", "", []
            ok = True
            for k in range(len(rows) + 1):
                for _ in range(fill[k]):
                    role = "assistant" if roles[-1:] == "u" else "user"
                    cost, audit, roles = cost + 3, audit + "I", roles + role[0]
                    out.append(f"{role}:")
                if k == len(rows):
                    break
                role, text, gone, extra = rows[k]
                if kinds[k] == "D":
                    cost += 4
                else:
                    if gone:
                        ok = False
                        break
                    if kinds[k] == "R":
                        role = "assistant" if roles[-1:] == "u" else "user"
                    cost += extra + 3 * (kinds[k] == "R")
                    roles += role[:1] or "x"
                    out.append(f"{role}:{text}")
                audit += kinds[k]
            body = roles[1:] if roles.startswith("s") else roles
            legal = not roles or body and body == "ua" * (len(body) // 2)
            if ok and legal and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=conversations.LETTERS, max_size=4))
def test_every_string_gets_its_cheapest_least_audit(letters):
    symbols = [conversations.LETTERS.index(c) for c in letters]
    rows = [(c.lower(), "t", c == conversations.GONE, 3 if c.isupper() else 0) for c in letters]
    want = _spelled(rows)[:2]
    assert conversations.Repairs([]).of(symbols) == want
    rules = [(0, 1), (1, 2), (9, 2), (10, 10), (8, 8), (2, 1)]
    left, changed = symbols, True
    while changed:
        new = conversations._replaced(left, {pair: 9 + k for k, pair in enumerate(rules)})
        left, changed = new, new != left
    assert conversations.Repairs(rules).of(left) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=12), st.integers(0, 40), st.integers(0, 40))
def test_ropes_compare_as_their_texts(joins, a, b):
    audits = conversations.Audits()
    known = [audits.of(x) for x in ("D", "I", "K", "R", "", "KD", "KDI")]
    for x, y in joins:
        known.append(audits.of((known[x % len(known)], known[y % len(known)])))
    a, b = known[a % len(known)], known[b % len(known)]
    assert audits.less(a, b) == (audits.text(a) < audits.text(b))


def _plain(rows):
    """digests of (conv_id, turn, role, text) rows that are damaged already, by plain loops and trying all edits."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " "))
        seen, edits, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        for k, (_, _, role, text) in enumerate(mine):
            role, text = (" " if x is None else x for x in (role, text))
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            if k and (mine[k - 1][2] or " ")[:1] + role[:1] not in ("su", "ua", "au"):
                counts["illegal"] += 1
            edits.append((role, text, fault in ("blank", "duplicate"), 3 * (fault == "truncated")))
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit, repaired = _spelled(edits)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts.values(), cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Yes"), (1, 9, "user", "And?"),
    (2, None, None, None), (2, 3, "user", " \t\n"), (2, 3, "user", "x."),
    (3, 5, "User", "Upper."), (3, 6, "admin", "starts with a. \r\n"), (3, 7, "", "no role."),
    (None, 1, "assistant", "first."), (None, 2, "assistant", "first."), (None, 2, "user", "no end"), (None, None, "user", "ends ."),
    (4, 1, "user", "a.b"), (4, 1, "user", "a.b"), (4, 1, "assistant", "tie."),
    (5, None, "assistant", "x."), (5, None, "assistant", "x."),
]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(*r, "c", 1) for r in ODD], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in conversations.digests(rows, rows).collect()}
    assert got == _plain(ODD)


def test_ids_without_rows_and_empty_tables(spark):
    given_rows = spark.createDataFrame([(*r, "c", 1) for r in ODD], SCHEMA)
    none = given_rows.where("conv_id = 4")
    got = {r[0]: tuple(r)[1:] for r in conversations.digests(none, given_rows).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert set(got) == {1, 2, 3, 4, 5, None} and all(v == (0, 0, 0, 0, 0, 0, "", empty) for k, v in got.items() if k != 4)
    nothing = spark.createDataFrame([], SCHEMA)
    assert conversations.digests(conversations.damage(nothing), nothing).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(12) for t in range(12)] + [(None, 3, None, None), (3, None, "system", "x")]
    got = conversations.damage(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)).collect()
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_a_long_conversation_goes_through_rules_and_blocks(spark):
    n = 3 * conversations.BLOCK + 5
    rows = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, IF(id % 1000 = 7, '', '.')) AS text")
    one = conversations.digests(rows, rows).collect()
    assert len(one) == 1 and one[0].truncated == n // 1000 + 1 and one[0].gaps == 0
    assert one[0].audit == "K" * n + "I" and one[0].cost == 3 * one[0].truncated + 3
    text = "\n".join(f"{'ua'[i % 2].replace('u', 'user').replace('a', 'assistant') if i % 2 == 0 else 'assistant'}:t{i}{'' if i % 1000 == 7 else '.'}" for i in range(n)) + "\nassistant:"
    assert one[0].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_frequent_pairs_become_rules(spark):
    strings = spark.createDataFrame([("ua" * k,) for k in range(1, 40)] + [("s" + "ua" * k,) for k in range(30)], "letters string")
    table, rules = conversations.grammar(strings)
    assert (1, 2) in rules and len(rules) > 3
    expand = {k: c for k, c in enumerate(conversations.LETTERS)}
    for k, (a, b) in enumerate(rules):
        expand[len(conversations.LETTERS) + k] = expand[a] + expand[b]
    got = table.collect()
    assert all("".join(expand[s] for s in r.symbols) == r.letters for r in got)
    assert sum(len(r.symbols) for r in got) < sum(len(r.letters) for r in got) / 2



def test_repaired_rows_are_those_of_the_digest(spark):
    rows = spark.createDataFrame([(*r, "c", 1) for r in ODD], SCHEMA)
    out = conversations.repaired_rows(rows, rows)
    assert out.columns == ["conv_id", "place", "edit", "turn", "role", "text"]
    got: dict = {}
    for r in sorted(out.collect(), key=lambda r: r.place):
        got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, (*_, digest) in _plain(ODD).items():
        assert hashlib.sha256("\n".join(got.get(conv, [])).encode()).hexdigest() == digest
