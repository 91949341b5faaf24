import hashlib
import re

from tests.llm.cases import awkward, empty

from citeflow.llm import decontaminate, queries


def _words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w, item = _words(text), "" if item is None else item
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for number, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found - {""})).encode()).hexdigest()
        out.append((number, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def brute_longest(text, items):
    """(words, at, item, item_at) of the longest match that holds a window, by trying all pairs of places."""
    w, best = _words(text), None
    for item, other in items:
        o = _words(other)
        for i in range(len(w)):
            for j in range(len(o)):
                if w[i] == o[j] and not (i and j and w[i - 1] == o[j - 1]):
                    n = 1
                    while i + n < len(w) and j + n < len(o) and w[i + n] == o[j + n]:
                        n += 1
                    if n >= min(13, len(o)):
                        key = (-n, i, item is not None, str(item or ""), j)
                        best = min(best or key, key)
    return (-best[0], best[1], best[3] if best[2] else None, best[4]) if best else (0, None, None, None)


FIRST = "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"


def _pairs(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_equals_brute_force_on_the_table(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute(_pairs(docs, "doc_id", "text"), _pairs(items, "item_id", "text"))
    assert any(r[5] for r in want)
    assert sorted(_pairs(queries.op5_decontaminate(spark, sf), *FIRST), key=str) == want


def test_short_items_repeats_and_blocks(spark, monkeypatch):
    long = " ".join(f"w{k % 7}" for k in range(60))
    items = [(1, "The cat sat"), (2, "cat"), (3, None), (4, "--"), (5, long), (5, "mat the cat"), (6, "The, CAT sat"), (7, "déjà Vu")]
    items.append((None, "now 10 0 0"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS item", "2 AS doc_id")
    extra = spark.createDataFrame([(20, long + " " + long), (21, "a cat, the CAT sat"), (22, "x " * 50 + long)], "doc_id bigint, text string")
    docs = awkward(spark).select("doc_id", "text").union(extra)
    want = brute(_pairs(docs, "doc_id", "text"), items)
    longest = {n: brute_longest(t, items) for n, t in _pairs(docs, "doc_id", "text") if n not in (6, 7)}
    for size, pairs, words in ((1 << 20, 1 << 22, 1 << 20), (400, 1 << 22, 8), (1 << 20, 5, 1 << 20)):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        monkeypatch.setattr(decontaminate, "MOST_PAIRS", pairs)
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", words)
        found = decontaminate.contamination(docs, benchmark)
        assert sorted(_pairs(found, *FIRST), key=str) == want
        assert {r[0]: r[1:] for r in _pairs(found, "doc_id", "longest_words", "longest_at", "longest_item", "longest_item_at") if r[0] in longest} == longest


def test_filter_keeps_rows_and_columns(spark):
    docs = awkward(spark)
    benchmark = spark.createDataFrame([(1, "the cat sat on the mat the cat sat on the mat the cat sat")], "item_id bigint, text string")
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    clash = docs.selectExpr("*", "1 AS __n_words", "2 AS __ranges", "'x' AS __items")
    assert decontaminate.decontaminate(clash, benchmark).columns == clash.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 5, 8, 9]
    assert decontaminate.contamination(empty(spark), benchmark).count() == 0
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("contaminated").count() == 0
