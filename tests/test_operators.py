import random

import pytest
from pyspark.sql import functions as F

from citeflow.functions import text as tx
from citeflow.operators import evaluate, overlap, sequence, spans, splits
from citeflow.operators.decide import decide
from citeflow.schema import FORM_RANK, PATH_CLASS, REGISTRY

MENTION = "mention_id string, form string, court string, case_class string, appeal_chain array<string>, number string, state string, law_key string, article string, fields_read boolean"


def _registry(spark):
    rows = [
        ("1", "acordao", "STJ", "1741784", "REsp", [], "PR", 2020, None, None, None),
        ("2", "acordao", "STJ", "500", "REsp", [], "PR", 2020, None, None, None),
        ("3", "acordao", "STJ", "500", "REsp", ["AgInt"], "PR", 2020, None, None, None),
        ("4", "acordao", "STJ", "777", "HC", [], "SP", 2020, None, None, None),
        ("5", "sumula", "STJ", "S83", None, [], None, 2020, None, None, None),
        ("6", "sumula", "STF", "SV10", None, [], None, 2020, None, None, None),
        ("7", "dispositivo", None, None, None, [], None, 2020, None, "LEI-13105-2015", "373"),
        ("8", "dispositivo", None, None, None, [], None, 2020, None, "DL-5452-1943", "818"),
        ("9", "dispositivo", None, None, None, [], None, 2020, None, "DL-5452-1943", "818"),
        ("10", "acordao", "STJ", "1234", "AI", [], "MG", 2020, None, None, None),
    ]
    return spark.createDataFrame(rows, REGISTRY)


CASES = [
    ("sem_numero", "sem_numero", {"court": "STF"}, None),
    ("numero_ausente", "com_numero", {"number": "999999", "case_class": "REsp"}, None),
    ("numero_contradito", "com_numero", {"number": "1741784", "case_class": "HC"}, None),
    ("numero_unico", "com_numero", {"number": "1741784", "case_class": "REsp", "state": "PR"}, "1"),
    ("numero_desempatado", "com_numero", {"number": "500", "case_class": "REsp", "appeal_chain": ["AgInt"]}, "3"),
    ("numero_ambiguo", "com_numero", {"number": "500", "case_class": "REsp"}, None),
    ("lei_apelido_desconhecido", "lei_artigo", {"article": "5"}, None),
    ("lei_ausente", "lei_artigo", {"law_key": "LEI-13105-2015", "article": "1134"}, None),
    ("lei_unica", "lei_artigo", {"law_key": "LEI-13105-2015", "article": "373"}, "7"),
    ("lei_ambigua", "lei_artigo", {"law_key": "DL-5452-1943", "article": "818"}, None),
    ("referencia_vaga", "referencia_vaga", {}, None),
    ("numero_ausente", "com_numero", {"number": "1234"}, None),
    ("numero_unico", "sumula", {"number": "S083"}, "5"),
    ("numero_unico", "com_numero", {"number": "777", "case_class": "RHC", "appeal_chain": ["AgRg"]}, "4"),
    ("numero_contradito", "com_numero", {"number": "777", "case_class": "HC", "appeal_chain": ["AgRg"]}, None),
    ("numero_contradito", "com_numero", {"number": "777", "case_class": "HC", "state": "RJ"}, None),
    ("campos_nao_lidos", "com_numero", {"fields_read": False}, None),
]


def test_every_decision_path(spark):
    rows = []
    for k, (_, form, fields, _) in enumerate(CASES):
        f = {"appeal_chain": [], "fields_read": True} | fields
        rows.append((str(k), form, f.get("court"), f.get("case_class"), f["appeal_chain"], f.get("number"), f.get("state"), f.get("law_key"), f.get("article"), f["fields_read"]))
    got = {int(r["mention_id"]): r for r in decide(spark.createDataFrame(rows, MENTION), _registry(spark)).collect()}
    for k, (path, _, _, target) in enumerate(CASES):
        assert (got[k]["path"], got[k]["verdict"], got[k]["canonical_id"]) == (path, PATH_CLASS[path], target), CASES[k]


def _plain_resolve(items):
    def inside(a, b):
        return a[0] >= b[0] and a[1] <= b[1] and a[:2] != b[:2]

    chosen = []
    for x in sorted(items, key=lambda x: (-FORM_RANK[x[2]], x[0] - x[1], x[0])):
        if any(inside(x, y) for y in chosen):
            continue
        rivals = [y for y in chosen if not inside(y, x)]
        shares = [(c := max(0, min(x[1], y[1]) - max(x[0], y[0]))) > 0 and 2 * c >= x[1] - x[0] + y[1] - y[0] - c for y in rivals]
        if not any(shares):
            chosen = [*rivals, x]
    return set(chosen)


def test_overlap_resolution_whatever_the_order(spark):
    rng = random.Random(3)
    docs = {k: {(a := rng.randrange(60), a + rng.randrange(1, 25), rng.choice(list(FORM_RANK))) for _ in range(rng.randrange(1, 9))} for k in range(80)}
    rows = [(k, *m, ["regex"]) for k, ms in docs.items() for m in ms]
    rng.shuffle(rows)
    mentions = spark.createDataFrame(rows, "doc_id bigint, start int, end int, form string, origins array<string>").repartition(7)
    got = {}
    for r in overlap.resolve_overlaps(mentions).collect():
        got.setdefault(r["doc_id"], set()).add((r["start"], r["end"], r["form"]))
    assert got == {k: _plain_resolve(ms) for k, ms in docs.items()}


def test_run_difference(spark):
    schema = "doc_id string, id int, start int, end int, label string, target string"
    a = spark.createDataFrame([("d", 1, 0, 10, "real", "1"), ("d", 2, 50, 60, "inventada", None)], schema)
    b = spark.createDataFrame([("d", 1, 0, 10, "incompleta", None), ("d", 2, 100, 110, "real", "2")], schema)
    assert sorted(r["change"] for r in overlap.run_difference(a, b).collect()) == ["appeared", "changed", "gone"]
    assert {r["change"] for r in overlap.run_difference(a, a).collect()} == {"same"}


@pytest.mark.parametrize("n", [1, 509, 510, 511, 900, 5000])
def test_windows_cover_and_own(spark, n):
    row = spark.range(1).select(sequence.windows(F.lit(n)).alias("w")).select("w", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda t: sequence.token_owner(t, F.col("w"))).alias("own")).first()
    w = [(x["start"], x["end"]) for x in row["w"]]
    assert w[0][0] == 0 and w[-1][1] == n and all(b - a <= 510 for a, b in w)
    assert all(y[0] - x[0] <= 382 for x, y in zip(w, w[1:]))
    for t, k in enumerate(row["own"]):
        depth = [min(t - a, b - 1 - t) if a <= t < b else -1 for a, b in w]
        assert k == depth.index(max(depth))


def test_words_are_tagged_within_their_texts(spark):
    """As ``bio_labels`` does it for all words, without sorting or joining any words: only stretches around numbers are shuffled."""
    word, number, run = "[A-Za-z0-9]+", "[0-9][0-9.]+[0-9]", "[A-Za-z0-9.]"
    rng = random.Random(3)
    texts = ["", "no number 1 22", "1.234 a", "x12.34y56.78z 9", "a 1..2. 3.4.5b", "é12.5é a.123.b.456 \x01 77777", *("".join(rng.choice("1 2.a.é\n9") for _ in range(300)) for _ in range(40))]
    docs = spark.createDataFrame([*enumerate(texts), (999, None)], "doc_id bigint, text string")
    got = sequence.bio_labels_in_text(docs, "text", word, number, f"(?<!{run}){run}*?{number}{run}*", "NUM")
    words = spans.regexp_spans(docs, ["doc_id"], "text", word, many=True)
    order = sequence.Window.partitionBy("doc_id").orderBy("start")
    want = sequence.bio_labels(words.select("doc_id", F.row_number().over(order).cast("long").alias("token"), "start", "end"), spans.regexp_spans(docs, ["doc_id"], "text", number).withColumn("label", F.lit("NUM")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.where("tag <> 'O'").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_bio_round_trip(spark):
    tokens = spark.createDataFrame([(1, k, 10 * k, 10 * k + 8) for k in range(10)], "doc_id int, token int, start int, end int")
    gold = spark.createDataFrame([(1, 12, 38, "A"), (1, 40, 48, "A"), (1, 75, 95, "B")], "doc_id int, start int, end int, label string")
    tags = sequence.bio_labels(tokens, gold)
    assert [r["tag"] for r in tags.orderBy("token").collect()] == ["O", "B-A", "I-A", "I-A", "B-A", "O", "O", "B-B", "I-B", "I-B"]
    found = {(r["start"], r["end"], r["label"]) for r in sequence.bio_decode(tags).collect()}
    assert found == {(10, 38, "A"), (40, 48, "A"), (70, 98, "B")}


def test_spans_sparse_and_dense_agree(spark):
    texts = ["a 12 b345", "😀 7 é 88\x019", "none", "", None, "5 " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    few, many = (sorted(map(tuple, spans.regexp_spans(docs, ["doc_id"], "text", "[0-9]+", many=m).collect())) for m in (False, True))
    assert few == many and len(few) == 2 + 3 + 300
    assert all(t[3] == texts[t[0]][t[1] : t[2]] for t in few)


def test_header_end(spark):
    texts = ["PROCESSO 12\nCURTO\n\nO texto corrido começa aqui, em letras pequenas.\nFIM", "", "só isto corre por aqui", "TUDO\nEM CAIXA"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(spans.header_end("t")).collect()]
    assert got == [texts[0].index("O texto"), 0, 0, len(texts[3])]


@pytest.mark.parametrize(("raw", "want"), [("l.027", "1.027"), ("3I. 904", "31. 904"), ("6.204.311-SC", "6.204.311-SC"), ("40826l5", "4082615"), ("g.570.126", "9.570.126"), ("2017.S.15", "2017.5.15"), ("So", "So")])
def test_group_repair(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x string").select(tx.repair_groups(F.col("x"))).first()[0] == want


def test_rendering(spark):
    row = spark.createDataFrame([("6204311", "5120820175150044")], "a string, b string").select(tx.with_thousands(F.col("a")), tx.masked(F.col("b")), tx.collapse_number(F.lit("6. 405.118 - CE")), tx.fold(F.lit("Súmula ÇÃO"))).first()
    assert tuple(row) == ("6.204.311", "0000512-08.2017.5.15.0044", "6.405.118-CE", "sumula cao")


def test_perfect_scores(spark):
    rows = [(1 + k % 2, c, c, "1", "1", 1.0) for k, c in enumerate(["real", "inventada", "incompleta"] * 6)]
    schema = "tier int, gold_class string, found_class string, gold_target string, found_target string, confidence double"
    assert evaluate.overall_score(evaluate.tier_scores(spark.createDataFrame(rows, schema))).first()[0] == pytest.approx(1.1)
    sure = [(*r[:5], None) for r in rows]
    assert evaluate.overall_score(evaluate.tier_scores(spark.createDataFrame(sure, schema))).first()[0] == pytest.approx(1.0)
    wrong = [(t, g, "real", a, "2", None) for t, g, _, a, _, _ in rows]
    assert evaluate.overall_score(evaluate.tier_scores(spark.createDataFrame(wrong, schema))).first()[0] == pytest.approx(0.0)


def test_calibration_never_does_worse_than_the_constant(spark):
    rows = [("a", 1)] * 10 + [("b", 1)] * 6 + [("c", 0)] * 4 + [("c", 1)]
    out = {r["path"]: r for r in evaluate.calibrate(spark.createDataFrame(rows, "path string, hit int"), ["path"]).collect()}
    pooled = (17 + 6.79) / 28
    assert out["a"]["rate"] == pytest.approx(16.79 / 17) and out["c"]["rate"] == pytest.approx(7.79 / 12)
    for path, r in out.items():
        ys = [y for p, y in rows if p == path]
        assert sum((y - r["rate"]) ** 2 for y in ys) <= sum((y - pooled) ** 2 for y in ys) + 1e-12


def test_splits(spark):
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 2).alias("tier"))
    control = [r["id"] for r in splits.stratified_control(rows, "tier", "id", 6, seed=1).where("control").collect()]
    assert sorted(x % 2 for x in control) == [0] * 6 + [1] * 6
    again = [r["id"] for r in splits.stratified_control(rows.repartition(5), "tier", "id", 6, seed=1).where("control").collect()]
    assert sorted(control) == sorted(again)
    weights = {"x": 3, "y": 1}
    got = [r[0] for r in spark.range(4).select(splits.weighted_choice(F.col("id"), weights)).collect()]
    assert got == ["x", "x", "x", "y"]


def _mentions(spark, rows):
    return spark.createDataFrame(rows, "mention_id string, form string, court string, case_class string, appeal_chain array<string>, number string, state string, law_key string, article string, fields_read boolean")


def test_a_decision_that_took_another_record_is_broken(spark):
    from citeflow.operators.decide import decide, is_broken, registry_keys

    registry = spark.createDataFrame([("1", "STJ", "100", "REsp", [], None, None, None), ("2", None, None, None, [], None, "CF-1988", "5"), ("3", "STJ", "S7", None, [], None, None, None)], "id string, court string, number string, case_class string, appeal_chain array<string>, state string, law_key string, article string")
    mentions = _mentions(spark, [("a", "com_numero", None, "REsp", [], "100", None, None, None, True), ("b", "lei_artigo", None, None, [], None, None, "CF-1988", "5", True), ("c", "sumula", "STJ", None, [], "S007", None, None, None, True), ("d", "com_numero", None, "REsp", [], "999", None, None, None, True)])
    good = decide(mentions, registry, with_record=True)
    assert {r["mention_id"]: r["canonical_id"] for r in good.collect()} == {"a": "1", "b": "2", "c": "3", "d": None}
    assert good.where(is_broken(with_record=True)).count() == 0 and decide(mentions, registry, strict=True).count() == 4
    keys = registry_keys(registry)
    torn = keys.withColumn("r_number", F.when(F.col("r_id") == "1", "101").otherwise(F.col("r_number")))
    assert [r["mention_id"] for r in decide(mentions, None, index=torn, with_record=True).where(is_broken(with_record=True)).collect()] == ["a"]
    with pytest.raises(Exception, match="broken decision: a"):
        decide(mentions, None, index=torn, strict=True).collect()


def test_a_written_index_is_not_shuffled(spark, tmp_path):
    from citeflow.operators.decide import decide, write_index
    from citeflow.plans.resolving import lineitem_registry, order_mentions

    sf = "/root/testdata/sf0.001"
    registry, mentions = lineitem_registry(spark.read.parquet(f"{sf}/lineitem.parquet")), order_mentions(spark.read.parquet(f"{sf}/orders.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("DROP TABLE IF EXISTS registry_index")
    try:
        registry.write.mode("overwrite").parquet(str(tmp_path / "r"))
        index = write_index(spark.read.parquet(str(tmp_path / "r")), "registry_index", 4)
        found = decide(mentions, None, index=index)
        plan = found._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scans = [i for i, line in enumerate(lines) if "registry_index" in line and "Scan" in line]
        assert len(scans) == 2
        for i in scans:
            depth = lines[i].index("FileScan") if "FileScan" in lines[i] else len(lines[i])
            above = []
            for line in reversed(lines[:i]):
                at = len(line) - len(line.lstrip(" :+-*()0123456789"))
                if at < depth:
                    depth = at
                    above.append(line)
                    if "Join" in line:
                        break
            assert not any("Exchange" in x for x in above), above
        want = decide(mentions, registry)
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS registry_index")


def test_registry_is_joined_once_and_alike_records_meet_a_mention_once(spark):
    rows = [(str(k), "acordao", "STJ", "500", "REsp", [], "PR" if k % 2 else "SP", 2020, None, None, None) for k in range(40)] + [(None, "acordao", "STJ", "500", "REsp", [], "MG", 2020, None, None, None)]
    mentions = [("a", "com_numero", None, "REsp", [], "500", "PR", None, None, True), ("b", "com_numero", None, "REsp", [], "500", "MG", None, None, True), ("c", "com_numero", None, "REsp", [], "501", None, None, None, True)]
    out = decide(spark.createDataFrame(mentions, MENTION), spark.createDataFrame(rows, REGISTRY), with_ids=True)
    got = {r["mention_id"]: r for r in out.collect()}
    assert [(got[m]["path"], got[m]["n_candidates"], got[m]["n_consistent"]) for m in "abc"] == [("numero_ambiguo", 41, 20), ("numero_contradito", 41, 0), ("numero_ausente", 0, 0)]
    assert got["a"]["consistent"] == sorted(str(k) for k in range(1, 40, 2)) and got["a"]["candidates"] == sorted(map(str, range(40))) and got["c"]["candidates"] == []
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
