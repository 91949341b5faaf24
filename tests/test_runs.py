import json

from pyspark.sql import functions as F

from citeflow.sources import runs


def test_settings_file_then_environment(tmp_path):
    (tmp_path / "c.toml").write_text("use_tagger = true\nseed = 4\n")
    got = runs.settings(str(tmp_path / "c.toml"), {"CITEFLOW_SEED": "9", "CITEFLOW_EXTRACT_VAGUE": "Sim", "OTHER": "1"})
    assert got == runs.Settings(True, True, 9)
    assert got.digest() != runs.Settings().digest() == runs.settings(None, {}).digest()
    assert runs.redacted({"A_TOKEN": "x", "PATH": "y"}) == {"A_TOKEN": "***", "PATH": "y"}


def test_content_digest_ignores_order_but_not_rows(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, t string")
    assert runs.same_content(a, a.repartition(5))
    assert not runs.same_content(a, a.distinct()) and not runs.same_content(a, a.fillna("x"))


def test_manifest_and_report(spark):
    verified = spark.createDataFrame([("numero_unico", "real"), ("numero_unico", "real"), ("lei_ausente", "inventada")], "path string, verdict string")
    made = runs.manifest(verified, runs.Settings(), {"verify": 1.0})
    assert made["paths"] == {"lei_ausente": 1, "numero_unico": 2} and made["classes"] == {"inventada": 1, "real": 2}
    rows = [(str(k), 1, g, f, "1", "1", 0.9) for k, (g, f) in enumerate([("real", "real"), ("inventada", "real"), ("incompleta", None)])]
    pairs = spark.createDataFrame(rows, "doc_id string, tier int, gold_class string, found_class string, gold_target string, found_target string, confidence double")
    text = runs.report(pairs)
    assert "| inventada | real | 1 |" in text and "| incompleta | sem_span | 1 |" in text and "- inventada as real: 1" in text
    data = json.loads(runs.report(pairs.withColumn("path", F.lit("p")).withColumn("snippet", F.lit("REsp 1")), as_json=True))
    assert {"gold_class": "inventada", "found_class": "real", "doc_id": "1", "path": "p", "snippet": "REsp 1"} in data["errors"] and len(data["tiers"]) == 1


def test_manifest_tells_its_inputs(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_bytes(b"one")
    (tmp_path / "in" / "deep" / "b.txt").write_bytes(b"two")
    verified = spark.createDataFrame([("numero_unico", "real")], "path string, verdict string")

    def made():
        return runs.manifest(verified, runs.Settings(), inputs={"docs": str(tmp_path / "in")}, environment={"API_KEY": "x", "HOME": "/h"})

    first = made()
    assert first["inputs"]["docs"]["files"] == 2 and first["inputs"]["docs"]["bytes"] == 6 and first["environment"] == {"API_KEY": "***", "HOME": "/h"}
    assert made() == first
    (tmp_path / "in" / "a.txt").write_bytes(b"onE")
    changed = made()
    assert changed["inputs"]["docs"]["digest"] != first["inputs"]["docs"]["digest"] and changed["tables"] == first["tables"] and len(first["tables"]) == 64
