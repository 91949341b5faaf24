import json
import os

import pytest

from citeflow.sources import readers, sinks

VERIFIED = "doc_id string, start int, end int, snippet string, form string, type string, verdict string, canonical_id string, confidence double"


def _verified(spark, target="1"):
    docs = spark.createDataFrame([("a", "veja o HC 4.901 aqui"), ("b", "nada")], "doc_id string, text string")
    return docs, spark.createDataFrame([("a", 7, 15, "HC 4.901", "com_numero", "jurisprudencia", "real", target, 0.5)], VERIFIED)


def test_documents_are_written_only_if_the_contract_holds(spark, tmp_path):
    docs, good = _verified(spark)
    sinks.write_documents(good, docs, str(tmp_path / "out"))
    row = spark.read.text(str(tmp_path / "out")).collect()
    assert [json.loads(r["value"])["doc_id"] for r in row] == ["a"] and json.loads(row[0]["value"])["citations"][0]["resolution"] == {"canonical_id": "1"}
    sinks.unpack_documents(spark, str(tmp_path / "out"), str(tmp_path / "each"), docs)
    assert [x for x in os.listdir(tmp_path / "each") if "=" in x] == ["doc_id=a"] and spark.read.text(str(tmp_path / "each")).first()["value"] == row[0]["value"]
    _, bad = _verified(spark, target=None)
    with pytest.raises(ValueError, match="target 1"):
        sinks.write_documents(bad, docs, str(tmp_path / "bad"))
    assert not os.path.exists(tmp_path / "bad")


def test_examples_round_trip_with_their_digest(spark, tmp_path):
    row = [("o", "d", "treino", "texto", [(0, 5, "JUR")], [])]
    from citeflow.operators.training import EXAMPLE

    examples = spark.createDataFrame(row, EXAMPLE)
    made = sinks.write_examples(examples, str(tmp_path))
    assert readers.examples(spark, str(tmp_path / "examples")).collect() == examples.collect()
    assert made["examples"] == 1 and json.loads(spark.read.text(str(tmp_path / "manifest")).first()[0]) == made


def test_a_synthetic_set_is_read_back(spark, tmp_path):
    docs = spark.createDataFrame([("x", "uma linha\noutra")], "doc_id string, text string")
    sinks.write_synthetic(docs, docs.select("doc_id"), docs.select("doc_id"), docs.select("doc_id"), str(tmp_path), 7)
    assert tuple(spark.read.json(str(tmp_path / "txt")).first()) == ("x", "uma linha\noutra")
    assert json.loads(spark.read.text(str(tmp_path / "manifest")).first()[0]) == {"seed": 7}


def test_publishing_is_all_or_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "run")
    frame = spark.range(3)

    def fail(place):
        raise RuntimeError("no")

    def rows(name):
        return spark.read.parquet(sinks.published(spark, path, name)).count()

    with pytest.raises(FileNotFoundError):
        sinks.published(spark, path, "a")
    sinks.publish(spark, path, {"a": frame.write.parquet, "b": frame.write.parquet})
    assert (rows("a"), rows("b")) == (3, 3)
    with pytest.raises(RuntimeError):
        sinks.publish(spark, path, {"a": spark.range(9).write.parquet, "b": fail})
    assert (rows("a"), rows("b")) == (3, 3) and len(os.listdir(f"{path}/runs")) == 1
    with monkeypatch.context() as m:
        m.setattr(sinks, "_point", fail)
        with pytest.raises(TypeError):
            sinks.publish(spark, path, {"a": spark.range(9).write.parquet, "b": frame.write.parquet})
    assert (rows("a"), rows("b")) == (3, 3)
    sinks.publish(spark, path, {"a": spark.range(9).write.parquet, "b": frame.write.parquet})
    assert (rows("a"), rows("b")) == (9, 3) and sorted(x for x in os.listdir(path) if not x.startswith(".")) == ["CURRENT", "runs"]
