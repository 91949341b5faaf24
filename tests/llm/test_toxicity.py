import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeflow.llm import toxicity
from citeflow.llm.deobfuscate import EDGE, ORDER, Model, Restorer, decoded, grams_of, lattice, paths_cost, pieces
from tests.llm import cases

WORDS = ["idiot", "stupid", "trash", "loser", "hello", "world", "letter", "the", "a", "cat", "sat", "on", "mat", "this", "is"]


def _model(words):
    counts = {}
    for w in words:
        for g in grams_of(w):
            counts[g] = counts.get(g, 0) + 1
    return Model(counts.items())


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab1$0. i!", min_size=1, max_size=6), st.lists(st.text(alphabet="abio", min_size=1, max_size=5), min_size=1, max_size=8))
def test_viterbi_finds_what_trying_all_paths_finds(stretch, words):
    model = _model(words)
    best = None
    for path in itertools.product(*lattice(stretch)):
        text = "".join(chars for chars, _ in path)
        cost = sum(c for _, c in path) + paths_cost(model, text)
        if best is None or cost > best + 1e-9:
            best = cost
    found = decoded(model, stretch)
    reached = max(sum(c for _, c in path) + paths_cost(model, "".join(x for x, _ in path)) for path in itertools.product(*lattice(stretch)) if "".join(x for x, _ in path).strip(EDGE) == found)
    assert abs(reached - best) < 1e-9


@pytest.mark.parametrize("text, want", [("1d10t", "idiot"), ("$tup1d", "stupid"), ("trrraaash", "trash"), ("l o s e r", "loser"), ("l.o.5.e.r", "loser"), ("tr@sh!", "trash"), ("looooooser", "loser")])
def test_restores(text, want):
    restored = Restorer(_model(WORDS * 5)).restored(f"This {text} is on the mat.").split()
    assert restored == ["this", want, "is", "on", "the", "mat."] or restored == ["this", want + "!", "is", "on", "the", "mat."]


def test_plain_text_stays():
    text = "the cat sat on the mat, 12 or 2024. a-b? (letter) hello!"
    assert Restorer(_model(WORDS)).restored(text) == text


def test_model_counts_like_plain_python(spark):
    docs = spark.createDataFrame([(1, "The cat, THE Été!"), (2, None), (3, "cat2cat")], "doc_id bigint, text string")
    want = {}
    for w in ["the", "cat", "the", "été", "cat", "cat"]:
        for g in grams_of(w):
            want[g] = want.get(g, 0) + 1
    assert toxicity.character_model(docs).counts == want
    model = _model(["the"])
    assert abs(sum(10 ** model.cost("t", c) for c in map(chr, range(97, 97 + 26))) - 1) < 0.5 and all(len(g) <= ORDER for g in model.counts)


def _documents(spark, disguise):
    """Every third text is insulting; where ``disguise`` is set its words are written with signs in rows held out."""
    rng = np.random.default_rng(3)
    hidden = {"idiot": "1d10t", "stupid": "stuuuupid", "trash": "t r a s h", "loser": "l0ser"}
    rows, labels = [], []
    for k in range(900):
        words = list(rng.choice(["hello", "world", "letter", "the", "cat", "sat", "mat", "this"], 20))
        if k % 3 == 0:
            for _ in range(3):
                word = str(rng.choice(list(hidden)))
                words.insert(int(rng.integers(len(words))), hidden[word] if disguise and zlib.crc32(str(k).encode()) % 3 == 1 else word)
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels)


@pytest.mark.parametrize("disguise", [False, True])
def test_held_out_rows_are_told_apart(spark, disguise):
    documents, labels, truth = _documents(spark, disguise)
    got = toxicity.toxicity(documents, labels).collect()
    assert len(got) == 900 and {r.held_out for r in got} == {True, False}
    wrong = [r for r in got if r.held_out and r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 3
    assert (sum(r.n_restored for r in got if r.held_out) > 0) == disguise


def test_given_tables(spark, sf):
    documents, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.toxicity(documents, labels).collect()}
    assert len(got) == documents.count()
    both = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p and not t for p, t in both) <= 0.02 * len(both) and sum(p and t for p, t in both) >= 0.5 * sum(t for _, t in both)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())


def test_labels_of_held_out_rows_change_nothing(spark):
    documents, labels, _ = _documents(spark, False)
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    scores = [{r.doc_id: r.score for r in toxicity.toxicity(documents, x).collect()} for x in (labels, turned)]
    assert scores[0].keys() == scores[1].keys() and max(abs(scores[0][k] - scores[1][k]) for k in scores[0]) < 1e-9


def test_odd_rows(spark):
    documents = cases.awkward(spark)
    labels = spark.createDataFrame([(1, 0, 1), (4, 0, 0), (4, 1, 1), (None, 1, 1), (6, 1, None), (99, 0, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(documents, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in documents.collect())
    assert all(0 <= r.score <= 1 for r in got)
    none = labels.where("false")
    assert {r.score for r in toxicity.toxicity(documents, none).collect()} == {0.5}
    assert toxicity.toxicity(cases.empty(spark), labels).count() == 0


def test_pieces_lose_no_word():
    text = " ".join(f"word{'xy' * (k % 7)}" for k in range(60_000))
    features = toxicity.Features(_model(WORDS), {"word": 0, "wordxy": 1, "wor-": 2})
    ids, values, changed = features.of(text)
    assert ids == [0, 1, 2, 3] and np.allclose(np.expm1(values[:3]), [sum(k % 7 == 0 for k in range(60_000)), sum(k % 7 == 1 for k in range(60_000)), 60_000]) and changed == 0


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n.", max_size=60), st.integers(1, 12))
def test_pieces_join_to_the_text_and_cut_no_run(text, size):
    cut = list(pieces(text, size))
    assert "".join(cut) == text
    assert sorted(x for p in cut for x in p.split()) == sorted(text.split())
