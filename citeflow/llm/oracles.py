"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from citeflow.llm.mixing import COMMON, DIMENSIONS, LEAST_LETTERS, OTHER, POWER, RARE, ROUNDS, TOPICS

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT row_number() OVER () AS i, CAST(item_id AS VARCHAR) AS item, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), ip AS (
  SELECT i, item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS q FROM i WHERE len(w) > 0
), win AS (
  SELECT i, item, n, q, array_to_string(w[q : q + n - 1], ' ') AS win FROM ip
), sizes AS (
  SELECT DISTINCT n FROM win
), dp AS (
  SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d WHERE len(w) > 0
), dw AS (
  SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS win FROM dp, sizes WHERE p + n - 1 <= len(w)
), m AS (
  SELECT r, p, q, dw.n, i, item FROM dw JOIN win ON dw.n = win.n AND dw.win = win.win
), hits AS (
  SELECT r, count(DISTINCT h) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS h FROM m) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM m) GROUP BY r
), chains AS (
  SELECT r, i, item, p, q, n, p - row_number() OVER (PARTITION BY r, i, q - p ORDER BY p) AS island FROM m
), matches AS (
  SELECT r, item, min(p) - 1 AS doc_at, min(q) - 1 AS item_at, min(n) + count(*) - 1 AS words FROM chains GROUP BY r, i, item, q - p, island
), best AS (
  SELECT r, words, doc_at, item, item_at FROM matches
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY words DESC, doc_at, item NULLS FIRST, item_at) = 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       CAST(coalesce(words, 0) AS INTEGER) AS longest_words, CAST(doc_at AS INTEGER) AS longest_at, best.item AS longest_item, CAST(item_at AS INTEGER) AS longest_item_at
FROM d LEFT JOIN hits ON d.r = hits.r LEFT JOIN items ON d.r = items.r LEFT JOIN best ON d.r = best.r
"""

OP6 = """
WITH x AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS p, unnest(embedding) AS c FROM embeddings
), good AS (
  SELECT vec_id FROM x GROUP BY vec_id HAVING bool_and(c IS NOT NULL AND isfinite(c))
), v AS (
  SELECT vec_id, p, CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) AS c FROM x WHERE vec_id IN (SELECT vec_id FROM good)
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, sum(q.c * v.c) AS score
  FROM v AS q JOIN v ON q.p = v.p AND q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
"""


def op9() -> str:
    """Topics, then raking unrolled: one materialised step for each dimension of each round."""
    steps = [
        f"""l AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, lang, text, [x for x in regexp_split_to_array(coalesce({_LOWER}, ''), '[^\\p{{L}}]+') if length(x) >= {LEAST_LETTERS}] AS words FROM documents
)""",
        f"""seeds AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(words)) AS word FROM l) GROUP BY word
  HAVING count(*) * {RARE} >= (SELECT count(*) FROM l) AND count(*) * {COMMON} <= (SELECT count(*) FROM l) ORDER BY n DESC, word LIMIT {TOPICS}
)""",
        """best AS MATERIALIZED (
  SELECT r, word FROM (SELECT r, word, count(*) AS c FROM (SELECT r, unnest(words) AS word FROM l) GROUP BY r, word) JOIN seeds USING (word)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY c DESC, n, word) = 1
)""",
        f"""d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(word, '{OTHER}') AS topic,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM l LEFT JOIN best ON l.r = best.r
)""",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS w FROM d GROUP BY 1, 2, 3)",
    ]
    for name in DIMENSIONS:
        share = f"pow(own, {POWER}) / (sum(pow(own, {POWER})) OVER ()) * (sum(own) OVER ())"
        steps.append(f"t_{name} AS MATERIALIZED (SELECT {name}, {share} AS target FROM (SELECT {name}, CAST(sum(tokens) AS DOUBLE) AS own FROM c0 GROUP BY 1))")
    k = 0
    for _ in range(ROUNDS):
        for name in DIMENSIONS:
            now = f"(SELECT {name}, sum(w) AS now FROM c{k} GROUP BY 1)"
            scaled = "CASE WHEN now > 0 THEN w * (target / now) ELSE 0 END"
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, tokens, {scaled} AS w FROM c{k} AS c JOIN {now} AS n ON c.{name} = n.{name} JOIN t_{name} AS t ON c.{name} = t.{name})")
            k += 1
    steps.append(f"p AS MATERIALIZED (SELECT source, lang, topic, coalesce(w / nullif(tokens, 0) / (SELECT max(w / nullif(tokens, 0)) FROM c{k}), 1.0) AS p FROM c{k})")
    drawn = "CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0"
    return (
        "WITH "
        + ",\n".join(steps)
        + f"\nSELECT doc_id, d.topic, n_tokens, round(p, 6) AS probability, {drawn} < p AS kept FROM d JOIN p ON d.source = p.source AND d.lang = p.lang AND d.topic = p.topic"
    )


def op13() -> str:
    """The repairs by a plain recursion over rows that carries, for each state, cost, audit and text."""

    def edit(state: str, cost: str, letter: str, text: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN struct_pack(cost := {state}.cost + {cost}, audit := {state}.audit || '{letter}', out := {state}.out || {text}) END"

    def least(*found: str) -> str:
        return f"list_sort(list_filter([{', '.join(found)}], lambda x: x IS NOT NULL))[1]"

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN NOT r.gone AND r.initial = '{initial}' THEN {edit(state, 'r.extra', 'K', keeps)} END"

    def rerole(state: str, role: str) -> str:
        return f"CASE WHEN NOT r.gone THEN {edit(state, '3 + r.extra', 'R', f"'{role}:' || r.text || chr(10)")} END"

    def put_in(state: str, role: str) -> str:
        return edit(state, "3", "I", f"'{role}:' || chr(10)")

    keeps = "r.role || ':' || r.text || chr(10)"
    dropped = {s: edit(f"p.{s}", "4", "D", "''") for s in "zsua"}
    crc = "list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END))"
    blank = r"NOT regexp_matches(text, '[^\x20\x09-\x0D]')"
    closed = f"SELECT c, pos, z, s, u, {least('a', put_in('u', 'assistant'))} AS a FROM (SELECT c, pos, z, s, a, {least('u', put_in('z', 'user'), put_in('s', 'user'), put_in('a', 'user'))} AS u FROM"
    return rf"""
WITH RECURSIVE ids AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM conversations)
), kinds AS MATERIALIZED (
  SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({crc}, CAST(4294967295 AS BIGINT)) % 20 AS kind
  FROM (SELECT c, turn, role, text, coalesce(CAST(v.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations AS v JOIN ids ON v.conv_id IS NOT DISTINCT FROM ids.conv_id)
), damaged AS MATERIALIZED (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds
), marked AS MATERIALIZED (
  SELECT *, row_number() OVER o AS pos, left(role, 1) AS initial, lag(left(role, 1)) OVER o AS before, {blank} AS blank,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open
  FROM damaged WINDOW o AS (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy)
), r AS MATERIALIZED (
  SELECT c, pos, turn, role, text, initial, blank, again AND NOT blank AS duplicate, open AND NOT blank AND NOT again AS truncated,
         blank OR again AS gone, CASE WHEN open AND NOT blank AND NOT again THEN 3 ELSE 0 END AS extra,
         before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM marked
), steps AS (
  {closed} (SELECT c, CAST(0 AS BIGINT) AS pos, struct_pack(cost := CAST(0 AS BIGINT), audit := '', out := '') AS z, CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, out VARCHAR)) AS s,
    CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, out VARCHAR)) AS u, CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, out VARCHAR)) AS a FROM ids))
  UNION ALL
  {closed} (SELECT r.c, r.pos, {dropped['z']} AS z, {least(dropped['s'], keep('p.z', 's'))} AS s,
    {least(dropped['u'], *(keep(f'p.{x}', 'u') for x in 'zsa'), *(rerole(f'p.{x}', 'user') for x in 'zsa'))} AS u,
    {least(dropped['a'], keep('p.u', 'a'), rerole('p.u', 'assistant'))} AS a
    FROM steps AS p JOIN r ON r.c = p.c AND r.pos = p.pos + 1))
), ends AS (
  SELECT c, {least('z', 'a')} AS best FROM steps QUALIFY row_number() OVER (PARTITION BY c ORDER BY pos DESC) = 1
), sums AS (
  SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal FROM r GROUP BY c
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(CASE WHEN best.out = '' THEN '' ELSE left(best.out, length(best.out) - 1) END) AS repaired_sha256
FROM ids JOIN ends USING (c) LEFT JOIN sums USING (c)
"""
