import pytest
from pyspark.sql import functions as F

from citeflow.operators.fields import read_fields
from citeflow.operators.normalise import normalise, with_norm
from citeflow.operators.parse_registry import parse_registry
from citeflow.plans.verify import extract, prepare, verify
from citeflow.schema import REGISTRY
from citeflow.streaming import verify_stream


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("HC\n45.901/RS", "HC 45.901/RS"), ("n° 7.310.442", "nº 7.310.442"), ("No 7.310.442", "nº 7.310.442"), ("n. 7.310.442", "nº 7.310.442"), ("RMS 60.517 – MT", "RMS 60.517-MT"),
        ("HC nº 6. 405.118-CE", "HC nº 6.405.118-CE"), ("40826l5", "4082615"), ("art. l.027", "art. 1.027"), ("HC nº g.570.126", "HC nº 9.570.126"), ("RMS n. 3I. 904/BA", "RMS nº 31.904/BA"), ("5úmula 93", "Súmula 93"),
        ("Súrnula", "Súmula"), ("rninistro", "ministro"), ("Temo", "Temo"), ("SÚRNULA", "SÚMULA"), ("Carmo Dias", "Carmo Dias"), ("forno lento", "forno lento"), ("plain words", "plain words"),
    ],
)
def test_normalise(raw, want):
    norm, at = normalise(raw)
    assert norm == want and len(at) == len(norm)
    assert at == sorted(at) and all(0 <= k < len(raw) for k in at)


SNIPPETS = [
    ("com_numero", "ADO 73"), ("com_numero", "ADI 412/GO"), ("com_numero", "AgInt nos EREsp 6.204.311/SC"), ("com_numero", "RE-778812-3"), ("com_numero", "HC nº 3.018.577 - AM"), ("com_numero", "TST-RR-40417-16.2019.5.03.0022"),
    ("com_numero", "Tema 2.061 da repercussão geral"), ("sumula", "Súmula 77, III e VI, do TST"), ("sumula", "Súmula 618/STJ"), ("sumula", "OJ 91/SDI-2/TST"), ("sumula", "Súmula Vinculante nº 33"),
    ("lei_artigo", "art. 188 do CDC"), ("lei_artigo", "art. 61, § 4º-A, da CLT"), ("lei_artigo", "artigo 8º da Lei nº 8.078/1990"), ("sem_numero", "decisão do STM de 2014, Rel. Min. Bento Modelo"), (None, "AP 31"), (None, "HC-7"), (None, "OJ 12"), (None, "o verbete 9 da lista"),
]


def test_extraction(spark):
    rows = [(str(k), f"Nesse sentido, {s}, e assim decido.") for k, (_, s) in enumerate(SNIPPETS)]
    got = {}
    for r in extract(prepare(spark.createDataFrame(rows, "doc_id string, text string"))).collect():
        got.setdefault(int(r["doc_id"]), []).append((r["form"], r["snippet"]))
    for k, (form, snippet) in enumerate(SNIPPETS):
        assert got.get(k, []) == ([(form, snippet)] if form else []), snippet


FIELDS = [
    ("AgRg no AREsp nº 6.204.311/SC", "com_numero", {"case_class": "AREsp", "appeal_chain": ["AgRg"], "number": "6204311", "state": "SC"}),
    ("TST-AIRR-ED-RR-512-08.2017.5.15.0044", "com_numero", {"court": "TST", "case_class": "RR", "appeal_chain": ["AIRR", "EDcl"], "number": "5120820175150044"}),
    ("Tema 2.061 da repercussão geral", "com_numero", {"number": "2061", "case_class": None}),
    ("RMS 60.517/MT", "com_numero", {"case_class": "RMS", "state": "MT", "appeal_chain": []}),
    ("HC nº l.905.226/BA", "com_numero", {"number": "1905226", "ocr_fixed": False}),
    ("HC nº 4.90l.226/BA", "com_numero", {"number": "4901226", "ocr_fixed": True}),
    ("art. 61, § 4º-A, da CLT", "lei_artigo", {"law_key": "DL-5452-1943", "article": "61"}),
    ("art. 1.027 da Lei nº 9.504/1997", "lei_artigo", {"law_key": "LEI-9504-1997", "article": "1027"}),
    ("Súmulas nºs 45 e 46 do STJ", "sumula", {"number": "S45", "court": "STJ"}),
    ("OJ 91/SDI-2/TST", "sumula", {"number": "OJ91", "court": "TST"}),
    ("Súmula Vinculante 33 do Supremo Tribunal Federal", "sumula", {"number": "SV33", "court": "STF"}),
    ("decisão do STM de 2014, Rel. Min. Bento Modelo", "sem_numero", {"court": "STM", "year": 2014, "relator": "bento modelo"}),
    ("jurisprudência pacífica", "referencia_vaga", {"number": None}),
]


def test_fields(spark):
    rows = [(k, s, f) for k, (s, f, _) in enumerate(FIELDS)]
    read = read_fields(with_norm(spark.createDataFrame(rows, "k int, snippet string, form string"), "snippet"))
    got = {r["k"]: r["fields"] for r in read.collect()}
    for k, (snippet, _, want) in enumerate(FIELDS):
        assert {c: got[k][c] for c in want} == want, snippet


def test_unreadable_fields_are_null(spark):
    rows = spark.createDataFrame([("um texto qualquer 908", "com_numero"), ("nenhum número", "sumula"), ("aresto de 2011", "sem_numero")], "snippet string, form string")
    assert [r["fields"] for r in read_fields(with_norm(rows, "snippet")).collect()] == [None] * 3


def test_registry_sources(spark):
    rows = [
        (1, "STJ", None, None, "acordao", "AgInt no RECURSO ESPECIAL Nº 6.204.311 - SC (2016/0044120-7) RELATORA : MINISTRA CLARA MODELO  RECORRENTE"),
        (2, "STF", 2013, "Min. Bento Modelo", "acordao", "AG.REG. NA RECLAMAÇÃO 18.042 MINAS GERAIS RELATORA : MIN. Z"),
        (3, "STM", None, None, "acordao", "APELAÇÃO Nº 7000412 - 19. 2020 . 7 . 03 . 0001/RS"),
        (4, "TSE", None, None, "acordao", "RECURSO ESPECIAL ELEITORAL Nº 21.554 ( 9917) - CLASSE 32ª OLINDA - PERNAMBUCO Relator: W"),
        (5, "TST", None, None, "acordao", "LEI Nº 13.467/2017. segue TST-IRR-88-01.2012.5.01.0002. nos autos de Recurso TST-ED-AIRR-512-08.2017.5.15.0044, em que"),
        (6, "STF", None, None, "sumula", "Súmula Vinculante n. 33 do STF"),
        (7, None, None, None, "dispositivo", "Artigo 12º da Lei nº 8.078, de 11 de setembro de 1990\ncorpo"),
        (8, None, None, None, "dispositivo", None),
        (9, "STJ", None, None, "sumula", "SÚMULA N. 0618"),
    ]
    got = {r["id"]: r for r in parse_registry(spark.createDataFrame(rows, "id int, tribunal string, ano int, relator string, natureza string, texto string")).collect()}
    assert (got["1"]["number"], got["1"]["state"], got["1"]["case_class"], got["1"]["appeal_chain"], got["1"]["year"], got["1"]["relator"]) == ("6204311", "SC", "REsp", ["AgInt"], 2016, "clara modelo")
    assert (got["2"]["number"], got["2"]["state"], got["2"]["case_class"], got["2"]["year"], got["2"]["relator"]) == ("18042", "MG", "Rcl", 2013, "bento modelo")
    assert (got["3"]["number"], got["3"]["state"]) == ("70004121920207030001", "RS")
    assert (got["4"]["number"], got["4"]["state"], got["4"]["case_class"]) == ("21554", "PE", "REspe")
    # the number skips incidents; the class is that of the first tokens in the text, whoever they belong to
    assert (got["5"]["number"], got["5"]["case_class"]) == ("5120820175150044", "IRR")
    assert (got["6"]["number"], got["7"]["law_key"], got["7"]["article"], got["8"]["article"], got["9"]["number"]) == ("SV33", "LEI-8078-1990", "12", None, "S618")


@pytest.fixture(scope="module")
def registry(spark):
    rows = [
        ("1", "acordao", "STJ", "4901226", "HC", [], "BA", 2020, None, None, None),
        ("7", "dispositivo", None, None, None, [], None, 2020, None, "LEI-8078-1990", "188"),
        ("5", "sumula", "STJ", "S45", None, [], None, 2020, None, None, None),
    ]
    return spark.createDataFrame(rows, REGISTRY)


CLEAN = "PARECER\nProcesso nº 1\n\nAssentou-se no HC nº 4.901.226/BA e na Súmula 45 do STJ. Leia-se o art. 188 do CDC, e o RMS nº 60.517/MT."
NOISY = "PARECER\nProcesso nº 1\n\nAssentou-se no HC n. 4.90l. 226 – BA e na 5úrnula 45 do STJ. Leia-se o art. 188 do CDC, e o RMS No 60.517/MT."


def test_clean_and_noisy_twins_agree(spark, registry):
    docs = spark.createDataFrame([("a", CLEAN), ("b", NOISY), ("c", ""), ("d", None)], "doc_id string, text string")
    out = {}
    texts = {"a": CLEAN, "b": NOISY}
    for r in verify(docs, registry).orderBy("start").collect():
        assert texts[r["doc_id"]][r["start"] : r["end"]] == r["snippet"]
        out.setdefault(r["doc_id"], []).append((r["form"], r["path"], r["verdict"], r["canonical_id"]))
    assert out["a"] == [("com_numero", "numero_unico", "real", "1"), ("sumula", "numero_unico", "real", "5"), ("lei_artigo", "lei_unica", "real", "7"), ("com_numero", "numero_ausente", "inventada", None)]
    assert out["b"] == out["a"] and set(out) == {"a", "b"}


def test_one_scan_and_two_kernels(spark, registry, tmp_path, capsys):
    spark.createDataFrame([("a", CLEAN), ("b", NOISY)], "doc_id string, text string").write.parquet(str(tmp_path / "docs"))
    verify(spark.read.parquet(str(tmp_path / "docs")), registry).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 2 and plan.count("FileScan parquet") == 1


def test_tagger_spans_pass_the_gates(spark, registry):
    text = "Corpo: o HC nº 4.901.226/BA e, mais além, o ARTG 188 do CDC; e o RMS sessenta 60517."
    spans = [("a", text.index("HC"), text.index("/BA"), "JUR"), ("a", text.index("RMS"), text.index("60517") + 5, "JUR"), ("a", text.index("mais"), text.index("além") + 4, "JUR"), ("a", text.index("ARTG"), text.index("CDC") + 3, "LEI")]
    found = verify(spark.createDataFrame([("a", text)], "doc_id string, text string"), registry, tagger=spark.createDataFrame(spans, "doc_id string, start int, end int, label string"))
    got = {r["snippet"]: (r["form"], r["fields"]["source"], r["path"]) for r in found.collect()}
    assert got == {"HC nº 4.901.226/BA": ("com_numero", "regras", "numero_unico"), "RMS sessenta 60517": ("com_numero", "encoder", "numero_ausente")}


def test_stream_gives_what_the_batch_gives(spark, registry, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("a", CLEAN), ("b", NOISY)):
        (tmp_path / "in" / f"{name}.txt").write_text(text)
    stream = verify_stream.document_stream(spark, str(tmp_path / "in"), per_trigger=1)
    verify_stream.start(stream, registry, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    batch = verify(spark.createDataFrame([("a", CLEAN), ("b", NOISY)], "doc_id string, text string"), registry)
    columns = ["doc_id", "start", "end", "path"]
    assert sorted(map(tuple, streamed.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))
    assert streamed.agg(F.countDistinct("doc_id")).first()[0] == 2


def test_registry_sources_are_dealt_out_and_header_lines_read_once(spark, sf):
    """One split of orders was one task for all headers; each line was put through its patterns several times."""
    from citeflow.operators.spans import header_end
    from citeflow.plans import citations

    assert citations._source(spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    said = header_end("text", labels=True)._jc.toString()
    assert said.count("OAB") == 1 and said.count("p{Ll}") == 1
