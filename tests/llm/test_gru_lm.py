import math
import sys
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.cases import awkward, empty

from citeflow.llm import gru_lm, queries


def brute(rows):
    """doc_id -> base columns; keyed by row."""
    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter()
    for (_, t), h in zip(rows, held, strict=True):
        if not h:
            counts.update(gru_lm.words_of((t or "").encode()))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, t), h in zip(rows, held, strict=True):
        words = gru_lm.words_of((t or "").encode())
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out.append((i, h, len(words), sum(counts[w] > 0 for w in words), n, round(base, 4)))
    return sorted(out, key=str)


def _base(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in df), key=str)


@pytest.mark.parametrize("head", [40, 200_000])
def test_base_columns(spark, sf, monkeypatch, head):
    monkeypatch.setattr(gru_lm.frequent, "__defaults__", (head,))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op10_gru_lm(spark, sf).collect()
    assert _base(got) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert all(r["score"] < 0 for r in got)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    held = [r for r in queries.op10_gru_lm(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_untrained_network_is_the_unigram_model(monkeypatch):
    monkeypatch.setattr(gru_lm, "WORDS", 50)
    v = _vocabulary()
    docs = [np.array([_index(v)[b"w3"], _index(v)[b"w7"], v.rare, _index(v)[b""]], dtype=np.int32)]
    got = gru_lm.score_ids(gru_lm.initial(v), v, docs)[0] + math.log10(5) - v.rare_norm()
    want = sum(math.log10((c + 1) / (v.tokens + v.types + 1)) for c in (970, 930, 4, 500))
    assert abs(got - want) < 1e-3


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = gru_lm.scores(docs).collect()
    assert _base(got) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert gru_lm.scores(empty(spark)).count() == 0


def _index(v):
    return {w: k for k, (w, _) in enumerate(v.words[: v.rare])}


def _all(v):
    return np.arange(v.classes)


def _vocabulary(words=70):
    head = [(b"", 500)] + [(f"w{k}".encode(), 1000 - 10 * k) for k in range(words)]
    return gru_lm.Vocabulary(head, sum(n for _, n in head) + 300, len(head) + 40)


def _random(v, seed=1):
    rng = np.random.default_rng(seed)
    return {k: (x + 0.2 * rng.normal(size=x.shape) * (x > -1e3)).astype(np.float32) for k, x in gru_lm.initial(v).items()}


def test_probabilities_add_up_to_one(monkeypatch):
    monkeypatch.setattr(gru_lm, "WORDS", 50)
    v = _vocabulary()
    p = _random(v)
    states = np.random.default_rng(0).normal(size=(1, gru_lm.HIDDEN)).astype(np.float32)
    total = sum(math.exp(gru_lm._outputs(p, v, states, np.array([k]), None, _all(v))[0][0]) for k in range(v.rare + 1))
    assert abs(total - 1) < 1e-4
    assert len(_index(v)) == 50 and b"" in _index(v)


def test_state_is_carried_to_the_end(monkeypatch):
    """Streams and windows give what one document after the other, step by step, gives."""
    monkeypatch.setattr(gru_lm, "WORDS", 50)
    v = _vocabulary()
    p, rng = _random(v), np.random.default_rng(3)
    docs = [rng.integers(0, v.rare + 1, n).astype(np.int32) for n in (1, 700, 3, 40, 40, 2, 311)]
    table, want = gru_lm._table(p), []
    for d in docs:
        h, total = np.zeros((1, gru_lm.HIDDEN), dtype=np.float32), 0.0
        for before, target in zip([v.rare + 1, *d[:-1]], d, strict=True):
            states, _ = gru_lm._forward(p, np.array([[before]]), np.array([[False]]), h, table, False)
            h = states[-1]
            total += gru_lm._outputs(p, v, h, np.array([target]), None, _all(v))[0][0]
        want.append(total / math.log(10))
    assert np.allclose(gru_lm.score_ids(p, v, docs), want, rtol=1e-4)


def test_gradients(monkeypatch):
    monkeypatch.setattr(gru_lm, "WORDS", 50)
    v = _vocabulary()
    p = {k: x.astype(np.float64) for k, x in _random(v).items()}
    rng = np.random.default_rng(5)
    inputs, starts = rng.integers(0, v.rare + 2, (6, 3)), np.zeros((6, 3), dtype=bool)
    starts[0], starts[3, 1] = True, True
    targets = rng.integers(0, v.rare + 1, 18)

    def loss(q):
        states, _ = gru_lm._forward(q, inputs, starts, np.zeros((3, gru_lm.HIDDEN)), gru_lm._table(q), False)
        return -gru_lm._outputs(q, v, states.reshape(18, -1).astype(np.float64), targets, None, _all(v))[0].sum()

    states, tape = gru_lm._forward(p, inputs, starts, np.zeros((3, gru_lm.HIDDEN)), gru_lm._table(p), True)
    grads = {k: np.zeros_like(x) for k, x in p.items()}
    _, into = gru_lm._outputs(p, v, states.reshape(18, -1).astype(np.float64), targets, grads, _all(v))
    gru_lm._backward(p, grads, inputs, starts, tape, into.reshape(6, 3, -1))
    for name in ("embed", "into", "bias", "over", "class_w", "class_b", "word_w"):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p[name].shape)
            if name == "embed":
                at = (int(rng.choice(inputs.reshape(-1))), at[1])
            q = {k: x.copy() for k, x in p.items()}
            q[name][at] += 1e-2
            up = loss(q)
            q[name][at] -= 2e-2
            assert abs((up - loss(q)) / 2e-2 - grads[name][at]) < 2e-2 + 0.05 * abs(grads[name][at]), name


def _trained(spark, rows):
    """The vocabulary and the weights after training on all rows."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    counts = gru_lm.count_words(docs)
    n, types = counts.selectExpr("sum(n)", "count(*)").first()
    v = gru_lm.Vocabulary(gru_lm.frequent(counts), n, types)
    return v, gru_lm.train(gru_lm.encode(docs, F.lit(False), v), v)


def test_every_training_document_teaches(spark):
    """Each text has a word of its own: its embedding moves only where the document was read."""
    rows = [(k, f"own{k} next{k} " * 30) for k in range(40)]
    v, p = _trained(spark, rows)
    start = gru_lm.initial(v)
    moved = {k for k in range(40) if not np.array_equal(p["embed"][_index(v)[b"own%d" % k]], start["embed"][_index(v)[b"own%d" % k]])}
    assert moved == set(range(40))


def test_a_single_document_teaches(spark):
    v, p = _trained(spark, [(1, "a b a b a b")])
    assert not np.array_equal(p["class_w"], gru_lm.initial(v)["class_w"])


def test_weights_do_not_depend_on_the_partitioning(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "LEARNER_TOKENS", 100)
    rows = [(k, f"a{k % 7} b c{k % 3} " * 12) for k in range(90)]
    _, p = _trained(spark, rows)
    _, q = _trained(spark, rows[::-1])
    assert all(np.array_equal(p[k], q[k]) for k in p)
    start = gru_lm.initial(gru_lm.Vocabulary([(b"", 1)], 1, 1))
    assert set(start) == set(p)


def test_trained_score_against_a_plain_pass(spark):
    """The scores of the query's own weights, computed document by document with plain loops over the formulas."""
    rows = [(k, " ".join(f"w{(k * j) % 17}" for j in range(1, 40))) for k in range(60)]
    v, p = _trained(spark, rows)
    index, sig = _index(v), lambda x: 1 / (1 + np.exp(-x))
    docs = [[index.get(w, v.rare) for w in gru_lm.words_of(t.encode())] for _, t in rows[:5]]
    want, n = [], gru_lm.HIDDEN
    for d in docs:
        h, total = np.zeros(n), 0.0
        for before, target in zip([v.rare + 1, *d[:-1]], d):
            x, u = p["embed"][before] @ p["into"] + p["bias"], h @ p["over"]
            z, r = sig(x[:n] + u[:n]), sig(x[n : 2 * n] + u[n : 2 * n])
            h = (1 - z) * np.tanh(x[2 * n :] + r * u[2 * n :]) + z * h
            c = v.classes if target == v.rare else target // v.per_class
            logits = h @ p["class_w"] + p["class_b"]
            total += logits[c] - np.log(np.exp(logits).sum())
            if c < v.classes:
                logits = h @ p["word_w"][c] + p["word_b"][c]
                total += logits[target - c * v.per_class] - np.log(np.exp(logits).sum())
        want.append(total / math.log(10))
    got = gru_lm.score_ids(p, v, [np.array(d, dtype=np.int32) for d in docs])
    assert np.allclose(got, want, rtol=1e-4)


def test_vocabulary_and_learners_grow():
    sizes = [gru_lm.Vocabulary([(b"", 9), *((b"w%d" % k, 5) for k in range(5000))], 10**6, types).rare for types in (5001, 10**6, 10**7)]
    assert sizes == [gru_lm.WORDS, 1000, 3162]
    few, many = gru_lm.learners(10**7), gru_lm.learners(10**9)
    assert 1 < few < many and 10**7 / few < 10**9 / many


def test_scores_alone_need_no_slopes_and_extreme_rows_are_shifted():
    rng = np.random.default_rng(3)
    for scale, shift in ((1, 0), (1, 200), (1, -200), (60, 0)):
        x = rng.normal(size=(40, 7)) * scale + shift
        x[:, 6] = -1e4
        target = rng.integers(0, 6, 40)
        own = x - x.max(axis=1, keepdims=True)
        want = own[np.arange(40), target] - np.log(np.exp(own).sum(axis=1))
        log, none = gru_lm._softmax(x.astype(np.float32), target, False)
        assert none is None and np.allclose(log, want, rtol=1e-4, atol=1e-4)
        log, slope = gru_lm._softmax(x.copy(), target, True)
        assert np.allclose(log, want) and np.allclose(slope.sum(axis=1), 0)
        assert np.allclose(slope[np.arange(40), target], np.exp(want) - 1)

def _made(texts, v=None):
    """What counting (or, with ``v``, encoding) makes of the texts, without Spark."""
    n = len(texts)
    columns = {"doc_id": np.arange(n), "text": pa.array(texts), "held_out": np.zeros(n, dtype=bool), "round": np.zeros(n, dtype=np.int32)}
    batch = pa.RecordBatch.from_pydict(columns | {"learner": np.zeros(n, dtype=np.int32), "dealt": np.arange(n)})
    return list((gru_lm._encode(v) if v else gru_lm._partial_counts)(iter([batch])))


def _kernel_rows(texts, v=None):
    return [r for made in _made(texts, v) for r in made.to_pylist()]


ODD = ["A b  a\tB\n", "", None, " \x0b\x0c\r ", "x\x1cy \x85z Ä ä", " a　b W3", "one", " w3 zz w3 zz q "]


@pytest.mark.parametrize("piece", [1, 9, 1 << 23])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_are_those_of_plain_splitting(monkeypatch, piece, kind):
    monkeypatch.setattr(gru_lm, "PIECE", piece)
    monkeypatch.setattr(gru_lm, "WORDS", 2)
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 3))
    words = [gru_lm.words_of((t or "").encode()) for t in ODD]
    want, got = Counter(w for own in words for w in own), Counter()
    for r in _kernel_rows(pa.array(ODD, kind)):
        got[r["word"]] += r["n"]
    assert got == want
    v = gru_lm.Vocabulary([(b"", 9), (b"a", 5), (b"w3", 4), (b"b", 2)], 30, 9)
    index = {w: k for k, (w, _) in enumerate(v.words)}
    for own, r in zip(words, _kernel_rows(pa.array(ODD, kind), v), strict=True):
        at = [index.get(w, -1) for w in own]
        assert np.frombuffer(r["ids"], dtype=v.ids_kind()).tolist() == [k if 0 <= k < v.rare else v.rare for k in at]
        assert (r["n_tokens"], r["n_known"], r["n_rare"]) == (len(at), sum(k >= 0 for k in at), sum(not 0 <= k < v.rare for k in at))
        assert math.isclose(r["logs"], sum(math.log10(v.words[k][1] + 1) for k in at if k >= 0))
        assert math.isclose(r["rare_logs"], sum(math.log10(v.words[k][1] + 1) for k in at if k >= v.rare), abs_tol=1e-12)
        assert {x["word"]: x["n"] for x in r["rare"]} == Counter(w for w, k in zip(own, at, strict=True) if k < 0)


def _calls(run):
    """Calls of compiled functions, which are what small texts and small classes cost."""
    seen = Counter()
    sys.setprofile(lambda frame, event, arg: seen.update([event]) if event == "c_call" else None)
    try:
        run()
    finally:
        sys.setprofile(None)
    return seen["c_call"]


def test_counting_and_encoding_make_no_calls_for_each_text(monkeypatch):
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    v, few, many = _vocabulary(), ["a w1 w2"] * 100, ["a w1 w2"] * 2000

    for given in (None, v):
        _made(few, given)
        assert _calls(lambda: _made(many, given)) < _calls(lambda: _made(few, given)) + 100


def test_a_window_takes_two_softmaxes(monkeypatch):
    monkeypatch.setattr(gru_lm, "PER_CLASS", 4)
    v, inner, seen = _vocabulary(90), gru_lm._softmax, []
    monkeypatch.setattr(gru_lm, "_softmax", lambda *x: seen.append(1) or inner(*x))
    states = np.zeros((v.rare + 1, gru_lm.HIDDEN), dtype=np.float32)
    gru_lm._outputs(_random(v), v, states, np.arange(v.rare + 1), None, _all(v))
    assert v.classes > 9 and len(seen) == 2


def test_a_long_text_takes_no_room_in_other_streams():
    v = _vocabulary()
    docs = [np.zeros(50_000, dtype=np.int32), *(np.zeros(1, dtype=np.int32) for _ in range(1023))]
    tracemalloc.start()
    streams = gru_lm.Streams(docs, v.rare, 1024)
    filled = sum(int(window[2].sum()) for window in streams.windows(1 << 14, 1 << 14))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert filled == 51_023 and peak < 30_000_000
