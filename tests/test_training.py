import pytest
from pyspark.sql import functions as F

from citeflow.operators import training


def test_every_label_needs_a_side(spark):
    labels, sides = spark.createDataFrame([("a",), ("b",)], "doc_id string"), spark.createDataFrame([("a", "treino")], "doc_id string, side string")
    assert training.with_sides(labels.where("doc_id = 'a'"), sides).first()["side"] == "treino"
    with pytest.raises(Exception, match="no side for b"):
        training.with_sides(labels, sides).collect()


def test_examples(spark):
    rows = [("x", "d1", "treino", "t", [(0, 5, "JUR"), (4, 9, "LEI")], []), ("x", "d2", "treino", "t", [(0, 5, "JUR")], [(5, 9)])]
    examples = spark.createDataFrame(rows, training.EXAMPLE)
    assert [r["doc_id"] for r in training.overlapping_examples(examples).collect()] == ["d1"]
    assert tuple(training.summary(examples).first()) == ("x", "treino", 2, 3, 1)


def test_mix(spark):
    rows = spark.range(300).select(F.lit("treino").alias("side"), F.when(F.col("id") < 10, "s").otherwise("l").alias("origin"), F.col("id").alias("key"), (F.col("id") >= 10).alias("empty"))
    counts = {r["origin"]: r["count"] for r in training.mixed(rows, {"s": 4}).groupBy("origin").count().collect()}
    assert counts["s"] == 40 and 60 < counts["l"] < 140
    assert training.challenger_wins(1.5, 0) and not training.challenger_wins(1.5, -0.1) and not training.challenger_wins(1.0, 0)


def test_paraphrases_shift_places(spark):
    text = "Antes. O REsp 10 decidiu. Depois."
    start = text.index("REsp 10")
    rows = [(k, text, start, start + 7, 7, 25, p) for k, p in enumerate(["Ficou decidido no [[X]], enfim.", "sem marca", "[[X]] e [[X]]", "no [[X]] 判决"])]
    out = training.paraphrased(spark.createDataFrame(rows, "k int, text string, start int, end int, sentence_start int, sentence_end int, paraphrase string"), "[[X]]").collect()
    assert [r["k"] for r in out] == [0]
    assert out[0]["text"] == "Antes. Ficou decidido no REsp 10, enfim. Depois." and out[0]["text"][out[0]["start"] : out[0]["end"]] == "REsp 10"


def test_all_spans_of_a_document_move(spark):
    text = "Aqui REsp 1 fica. Ali HC 22 fica. Fim Pet 333."
    spans = [("d", text.index(s), text.index(s) + len(s), s) for s in ("REsp 1", "HC 22", "Pet 333")] + [("e", 0, 2, "ab")]
    docs = spark.createDataFrame([("d", text), ("e", "ab cd")], "doc_id string, text string")
    given = [("d", 0, 17, "Consta [[X]]."), ("d", 18, 33, "Em [[X]] ficou bem mais claro."), ("d", 20, 30, "cruza [[X]]"), ("d", 34, 46, "[[X]] [[X]]"), ("e", 0, 5, "判 [[X]]")]
    new, moved = training.paraphrased_documents(docs, spark.createDataFrame(spans, "doc_id string, start int, end int, snippet string"), spark.createDataFrame(given, "doc_id string, sentence_start int, sentence_end int, paraphrase string"), "[[X]]")
    texts = {r["doc_id"]: r["text"] for r in new.collect()}
    assert texts == {"d": "Consta REsp 1. Em HC 22 ficou bem mais claro. Fim Pet 333.", "e": "ab cd"}
    rows = moved.collect()
    assert len(rows) == 4 and all(texts[r["doc_id"]][r["start"] : r["end"]] == r["snippet"] for r in rows)


def test_ignored_tokens_and_labels(spark):
    tokens = spark.createDataFrame([(1, 0, 0, 4), (1, 1, 5, 9), (1, 2, 9, 9)], "doc_id int, token int, start int, end int")
    ignored = spark.createDataFrame([(1, 6, 7)], "doc_id int, start int, end int")
    assert {r["token"]: r["masked"] for r in training.ignored_tokens(tokens, ignored).collect()} == {0: False, 1: True, 2: True}
    row = spark.range(1).select(*(training.mapped_label(F.lit("JUR"), F.lit(s), F.lit(b), F.lit(""), "7777", "(?i)tribunal local").alias(f"c{k}") for k, (s, b) in enumerate([("REsp 1", ""), ("REsp 7777", ""), ("REsp 1", "do Tribunal Local no "), ("tal julgado", "")]))).first()
    assert tuple(row) == ("citacao", "proprio", "fora", "ambigua")
