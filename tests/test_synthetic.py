import random

from pyspark.sql import functions as F

from citeflow.operators import noise, synthetic, tagger
from citeflow.operators.truth import truth
from citeflow.plans.generated import judged
from citeflow.schema import CLASS_FAMILIES, REGISTRY


def _registry(spark):
    rows = [(str(k), "acordao", "STJ", str(1_000_000 + 7919 * k), ["REsp", "HC", "RMS"][k % 3], [], ["PR", "SP", None][k % 3], 2020, None, None, None) for k in range(200)]
    rows += [(str(300 + k), "acordao", "TST", f"{1_000_000 + k}7820155240091", ["RR", "AIRR"][k % 2], ["AgRg"] if k % 3 == 0 else [], None, 2020, None, None, None) for k in range(40)]
    rows += [(str(400 + k), "acordao", "STJ", str(2_000_000 + k // 3), "REsp", [], ["PR", "SP", None][k % 3], 2020, None, None, None) for k in range(60)]
    rows += [(str(900 + k), "sumula", "STJ", f"S{80 + k}", None, [], None, None, None, None, None) for k in range(20)]
    rows += [(str(890 + k), "sumula", "STF", f"SV{3 + k}", None, [], None, None, None, None, None) for k in range(5)]
    rows += [(str(950 + k), "dispositivo", None, None, None, [], None, None, None, ["LEI-9504-1997", "CF-1988"][k % 2], str(30 + k)) for k in range(10)]
    return spark.createDataFrame(rows, REGISTRY)


def test_verification_agrees_with_the_truth(spark):
    registry = _registry(spark)
    docs, gold = synthetic.documents(spark, registry, 40, seed=4)
    docs, gold = docs.cache(), gold.cache()
    assert docs.count() == 80
    assert gold.join(docs, "doc_id").where(F.expr("substring(text, start + 1, end - start) <> snippet")).count() == 0
    rows = judged(docs, gold, registry).collect()
    clean, noisy = [r for r in rows if not r["noisy"]], [r for r in rows if r["noisy"]]
    assert len(clean) == len(noisy) > 180 and {r["kind"] for r in clean} == {*synthetic.KINDS}
    assert [(r["snippet"], r["verdict"], r["found_verdict"]) for r in clean if not r["right"]] == []
    assert sum(r["right"] for r in noisy) >= 0.95 * len(noisy)
    assert sum(r["snippet"] != s["snippet"] for r, s in zip(sorted(clean, key=lambda r: (r["pair"], r["place"])), sorted(noisy, key=lambda r: (r["pair"], r["place"])), strict=True)) > len(clean) / 2


def test_kinds_keep_their_promises(spark):
    registry = _registry(spark)
    cited = synthetic.citations(registry, spark.range(300).withColumnRenamed("id", "pair"), 9).where("kind IS NOT NULL").collect()
    verdicts = {}
    for r in cited:
        verdicts.setdefault(r["kind"], set()).add(r["verdict"])
    assert {k: v for k, v in verdicts.items() if k not in ("real_acordao", "emprestada")} == {
        "real_sumula": {"real"}, "real_lei": {"real"}, "inventada_numero": {"inventada"}, "mesmo_caso_outro_estagio": {"real"},
        "ambigua": {"incompleta"}, "sumula_inventada": {"inventada"}, "lei_inventada": {"inventada"}, "lei_desconhecida": {"inventada"}, "sem_numero": {"incompleta"}, "tema": {"inventada"},
    }
    borrowed = [r["verdict"] for r in cited if r["kind"] == "emprestada"]  # by chance one may fit another record of its number
    assert borrowed.count("inventada") > 0.8 * len(borrowed)
    total, weights = len(cited), sum(synthetic.KINDS.values())
    assert all(abs(sum(r["kind"] == k for r in cited) / total - w / weights) < 0.04 for k, w in synthetic.KINDS.items())
    numbers = {r["number"] for r in registry.collect()}
    assert not any("".join(filter(str.isdigit, r["surface"])) in numbers for r in cited if r["kind"] == "inventada_numero")


def test_long_ids_stay_apart(spark):
    pairs = spark.createDataFrame([(1_000_001,), (1_000_002,), (10_000_010,)], "pair long")
    docs, gold = synthetic.written(synthetic.citations(_registry(spark), pairs, 9), 9)
    assert docs.count() == 6 and {r["doc_id"] for r in docs.collect()} == {f"{p}{t}" for p in (1_000_001, 1_000_002, 10_000_010) for t in ("_l", "_r")}
    assert gold.join(docs, "doc_id").where(F.expr("substring(text, start + 1, end - start) <> snippet")).count() == 0


def test_kinds_without_rows_make_no_citation(spark):
    registry = _registry(spark).where("nature = 'sumula'")
    cited = synthetic.citations(registry, spark.range(60).withColumnRenamed("id", "pair"), 9).collect()
    kinds = {r["kind"] for r in cited}
    assert None in kinds and not kinds & {"real_acordao", "inventada_numero", "ambigua", "real_lei"} and {"real_sumula", "sumula_inventada", "tema"} <= kinds


def test_taken_numbers_are_passed_over(spark):
    wanted = spark.createDataFrame([(k, 0, "sumula_inventada") for k in range(200)], "pair long, place int, kind string").withColumn("row", F.struct(F.lit("S1").alias("number")))
    taken = spark.createDataFrame([(f"S{k}", None, None) for k in range(1, 1000) if k % 10], "number string, law_key string, article string")
    free = {r["pair"]: r["free"] for r in synthetic.free_keys(wanted, taken, 3).collect()}
    assert 60 < len(free) < 180 and all(int(v[1:]) % 10 == 0 for v in free.values())


def _eliminated(citation, registry):
    """The truth of one citation by plain loops."""
    key, court, state, case_class, chain = citation
    families = [{*f} for f in CLASS_FAMILIES]
    held = [r for r in registry if r[1] == key]
    left = []
    for rid, _, r_court, r_state, r_class, r_chain in held:
        kin = len(held) == 1 and case_class != r_class and any({case_class, r_class} <= f for f in families)
        if (court and r_court and court != r_court) or (state and r_state and state != r_state):
            continue
        if not kin and ((case_class and r_class and case_class != r_class) or (chain and chain != r_chain)):
            continue
        left.append(rid)
    return ("incompleta" if key is None or len(left) > 1 else "real" if left else "inventada", left[0] if len(left) == 1 else None)


def test_truth_equals_plain_elimination(spark):
    pick = random.Random(2)
    options = (["1", "2", "3"], [None, "", "STJ", "TST"], [None, "SP", "PR"], [None, "", "REsp", "AREsp", "HC"], [[], ["AgRg"], ["EDcl"]])
    records = [(str(k), *(pick.choice(x) for x in options)) for k in range(6)]
    asked = [tuple(pick.choice(x) for x in ([None, "1", "2", "3", "4"], *options[1:])) for _ in range(300)]
    registry = spark.createDataFrame([(r[0], r[1], None, None, r[2], r[3], r[4], r[5]) for r in records], "id string, number string, law_key string, article string, court string, state string, case_class string, appeal_chain array<string>")
    cited = spark.createDataFrame([(k, *a) for k, a in enumerate(asked)], "cite_id int, key string, court string, state string, case_class string, appeal_chain array<string>")
    got = {r["cite_id"]: (r["verdict"], r["canonical_id"]) for r in truth(cited, registry).collect()}
    assert got == {k: _eliminated(a, records) for k, a in enumerate(asked)}


def test_noise_leads_back_to_what_was_written(spark):
    texts = ["REsp nº 1.905.511/SP", "Súmula n. 83 do STJ", "Agravo Interno no HC n° 905.519 - RJ", "TST-AIRR-1234567-78.2015.5.24.0091", "a", "Turno m"]
    rows = spark.createDataFrame([(k, texts[k % len(texts)]) for k in range(240)], "k int, t string").select("k", "t", noise.noised(F.col("t"), "k", 7).alias("n")).collect()
    assert {r["n"]["edits"] for r in rows} == {0, 1, 2}
    for r in rows:
        text, places = r["n"]["text"], r["n"]["map"]
        assert len(text) == len(places) and places == sorted(places) and all(0 <= p < len(r["t"]) for p in places)
        same = sum(text[i] == r["t"][p] for i, p in enumerate(places))
        assert same >= len(text) - 2 * r["n"]["edits"] and (r["n"]["edits"] or text == r["t"])


def test_documents_do_not_depend_on_partitions(spark):
    registry = _registry(spark)
    a = sorted(map(tuple, synthetic.documents(spark, registry, 5, seed=1)[0].collect()))
    b = sorted(map(tuple, synthetic.documents(spark, registry.repartition(7), 5, seed=1)[0].collect()))
    assert a == b
    assert a != sorted(map(tuple, synthetic.documents(spark, registry, 5, seed=2)[0].collect()))


def test_tag_counts(spark):
    schema = "doc_id int, start int, end int, label string"
    gold = spark.createDataFrame([(1, 0, 10, "A")], schema)
    found = spark.createDataFrame([(1, 0, 9, "A"), (1, 20, 25, "A"), (1, 40, 45, "A")], schema)
    ignored = spark.createDataFrame([(1, 38, 50, "A")], schema)
    row = tagger.tag_counts(gold, found, ignored).first()
    assert (row["gold"], row["matched"], row["predicted"], row["correct"]) == (1, 1, 2, 1)
    assert [tuple(r)[3:] for r in tagger.recall(gold, found).collect()] == [(True, True)]
    assert tagger.forgiven(gold, found).count() == 1


def test_gates(spark):
    text = "Veja (Súmula 5 do STJ), súmula administrativa 7, art. 373 do CPC e art. 9 do acordo; REsp 10."
    spans = [(text.index(s), text.index(s) + len(s), label) for s, label in ((" (Súmula 5 do STJ)", "JUR"), ("súmula administrativa 7", "JUR"), ("art. 373 do CPC", "LEI"), ("art. 9 do acordo", "LEI"), ("REsp 10", "JUR"))]
    frame = spark.createDataFrame([("d", *s, text, 0) for s in spans], "doc_id string, start int, end int, label string, text string, body_start int")
    own = spark.createDataFrame([("d", text.index("art. 373"), text.index("art. 373") + 15)], "doc_id string, start int, end int")
    assert sorted(r["snippet"] for r in tagger.gated(frame, own).collect()) == ["REsp 10", "Súmula 5 do STJ"]


def test_tokens_on_raw_text(spark):
    text = "O  réu , João, foi."
    row = spark.createDataFrame([(text, ["O", "réu", ",", "João", "zz", "foi"])], "t string, k array<string>").select(tagger.laid_on(F.col("k"), F.col("t")).alias("p"), tagger.words_with_places("t").alias("w")).first()
    assert [None if p is None else text[p["start"] : p["end"]] for p in row["p"]] == ["O", "réu", ",", "João", None, "foi"]
    assert [w["snippet"] for w in row["w"]] == ["O", "réu", ",", "João", ",", "foi", "."]


def test_pairs_are_dealt_out_and_places_of_edits_found_once(spark, sf):
    """One split of customers was one task for all draws; a kind of noise looked through its text up to twelve times."""
    from citeflow.operators.noise import noised
    from citeflow.plans import generated

    assert generated._pairs(spark, sf).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert noised(F.col("text"), "pair", 5)._jc.toString().count("sequence(0, length(") <= 8 + 1
