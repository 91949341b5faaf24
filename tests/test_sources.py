import json
import sqlite3

from pyspark.sql import functions as F
from pyspark.sql.datasource import StringContains

from citeflow.sources import readers, sinks


def test_documents_keep_their_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Olá\r\nmundo\n".encode())
    (tmp_path / "b.md").write_text("no")
    assert [tuple(r) for r in readers.documents(spark, str(tmp_path)).collect()] == [("a", "Olá\r\nmundo\n")]


def test_gold_with_bom_quotes_and_newlines(spark, tmp_path):
    (tmp_path / "g.csv").write_text('nivel,documento_id,citacao_id,inicio,fim,trecho,tipo,classificacao,id_canonico\n1,d,c,0,5,"a ""b""\\nc",lei,real,7\n', encoding="utf-8-sig")
    row = readers.gold(spark, str(tmp_path / "g.csv")).first()
    assert (row["tier"], row["snippet"], row["canonical_id"]) == (1, 'a "b"\nc', "7")


def test_sqlite_in_ranges(spark, tmp_path):
    path = str(tmp_path / "r.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (id INTEGER, texto TEXT)")
        db.executemany("INSERT INTO t VALUES (?, CAST(? AS TEXT))", [(k, b"x\xff" if k == 3 else f"t{k}") for k in range(50)])
    rows = {r["id"]: r["texto"] for r in readers.sqlite(spark, path, "t", "id long, texto string").collect()}
    assert len(rows) == 50 and rows[3] == "x�" and rows[4] == "t4"


def test_sqlite_answers_comparisons_itself(spark, tmp_path):
    path = str(tmp_path / "r.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (id INTEGER, natureza TEXT, texto TEXT)")
        db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(k, ["acordao", "sumula", None][k % 3], f"t{k}") for k in range(60)])
    rows = readers.sqlite(spark, path, "t", "id long, natureza string")
    asked = rows.where("natureza = 'acordao' AND id > 30 AND id % 2 = 0")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "natureza" in plan and "texto" not in plan
    assert sorted(r["id"] for r in asked.collect()) == [36, 42, 48, 54]
    assert sorted(r["id"] for r in rows.where("natureza IN ('sumula', 'x') AND id <= 10").collect()) == [1, 4, 7, 10]
    reader = readers.SqliteReader(rows.schema, {"path": path, "table": "t", "partitions": "3"})
    left = list(reader.pushFilters([readers.EqualTo(("natureza",), "acordao"), readers.GreaterThan(("id",), 30), StringContains(("natureza",), "c")]))
    assert [type(f) for f in left] == [StringContains]
    assert sorted(r[0] for p in reader.partitions() for r in reader.read(p)) == [33, 36, 39, 42, 45, 48, 51, 54, 57]


def test_tagged_tokens_and_trace(spark, tmp_path):
    (tmp_path / "c.txt").write_text("O O\n, O\n\nSTF B-ORG\n")
    assert [tuple(r) for r in readers.tagged_tokens(spark, str(tmp_path / "c.txt")).collect()] == [("O", "O"), (",", "O"), ("STF", "B-ORG")]


SCHEMA = "doc_id string, start int, end int, snippet string, form string, type string, verdict string, canonical_id string, confidence double"


def test_submission_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    verified = spark.createDataFrame([("a", 9, 12, "x", "sumula", "jurisprudencia", "real", "5", 0.5), ("a", 0, 4, "y", "sumula", "jurisprudencia", "inventada", None, None)], SCHEMA)
    sinks.write_submission(docs, verified, str(tmp_path / "s"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "s").glob("part-*")) if p.stat().st_size)
    assert b'a,"0,4,inventada,-,-|9,12,real,5,0.5000"\r\n' in raw and b"b,-\r\n" in raw
    back = readers.submission(spark, str(tmp_path / "s")).orderBy("start").collect()
    assert [tuple(r) for r in back] == [("a", 0, 4, "inventada", None, None), ("a", 9, 12, "real", "5", 0.5)]


def test_json_leaves_absent_values_out(spark):
    verified = spark.createDataFrame([("a", 0, 4, "y", "sumula", "jurisprudencia", "inventada", None, None), ("a", 9, 12, "x", "sumula", "jurisprudencia", "real", "5", 0.5)], SCHEMA)
    got = json.loads(sinks.document_json(verified).first()["json"])
    assert [c["start"] for c in got["citations"]] == [0, 9]
    assert got["citations"][0]["resolution"] == {} and "confidence" not in got["citations"][0]
    assert got["citations"][1]["resolution"] == {"canonical_id": "5"}


def test_contract(spark):
    docs = spark.createDataFrame([("a", "0123456789 abcdef")], "doc_id string, text string")
    good = ("a", 0, 4, "0123", "sumula", "jurisprudencia", "real", "5", 0.5)
    bad = [
        ("a", 1, 4, "123", "sumula", "jurisprudencia", "inventada", None, None),
        ("a", 5, 6, "5", "sumula", "jurisprudencia", "inventada", "7", None),
        ("a", 6, 7, "6", "sumula", "jurisprudencia", "real", None, None),
        ("a", 7, 8, "x", "sumula", "jurisprudencia", "inventada", None, None),
        ("a", 8, 9, "8", "lei_artigo", "jurisprudencia", "inventada", None, None),
        ("a", 9, 10, "9", "sumula", "jurisprudencia", "inventada", None, 1.5),
        ("a", 15, 99, "f", "sumula", "jurisprudencia", "outra", None, None),
    ]
    assert sinks.violations(spark.createDataFrame([good], SCHEMA), docs).count() == 0
    rules = sorted(r["rule"] for r in sinks.violations(spark.createDataFrame([good, *bad], SCHEMA), docs).collect())
    assert rules == ["bounds", "class", "confidence", "overlap", "snippet", "snippet", "target", "target", "type"]


def test_trace_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 9, 12, "x", "sumula", "numero_unico", "real", "5", 0.5)], readers.TRACE)
    sinks.write_trace(rows, str(tmp_path / "t"))
    assert readers.trace(spark, str(tmp_path / "t")).select(*rows.columns).collect() == rows.collect()
    assert rows.select(F.count("*")).first()[0] == 1
