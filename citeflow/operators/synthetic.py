"""Seeded synthetic documents with known citations, as clean and noisy twins.

All choices come from hashes of (seed, pair, place), so a document is the same wherever and whenever it is made, and in any
engine with md5. Registry rows are drawn by a hashed bucket, in a join; nothing is numbered or listed on the driver. What a
citation means is not taken from how it was made: ``truth`` looks it up in the registry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow import dims
from citeflow.functions.text import masked, with_thousands
from citeflow.operators.noise import drawn, noised
from citeflow.operators.splits import weighted_choice
from citeflow.operators.truth import truth
from citeflow.schema import CLASS_FAMILIES

BUCKETS = 4096
#: Numbers that are tried for a citation of something that is not there.
ATTEMPTS = 8
#: Numbers that each place is dealt for its choices.
DEALT = 25

# How often each kind of citation is made.
KINDS = {
    "real_acordao": 28, "real_sumula": 4, "real_lei": 10, "inventada_numero": 12, "emprestada": 8, "mesmo_caso_outro_estagio": 6,
    "ambigua": 4, "sumula_inventada": 3, "lei_inventada": 6, "lei_desconhecida": 2, "sem_numero": 15, "tema": 2,
}
#: The registry rows that each kind is drawn from.
POOLS = {
    "real_acordao": "ruling", "inventada_numero": "ruling", "emprestada": "ruling", "mesmo_caso_outro_estagio": "staged", "ambigua": "shared",
    "real_sumula": "holding", "sumula_inventada": "holding", "real_lei": "article",
}
FORMS = {"real_sumula": "sumula", "sumula_inventada": "sumula", "real_lei": "lei_artigo", "lei_inventada": "lei_artigo", "lei_desconhecida": "lei_artigo", "sem_numero": "sem_numero"}

#: How classes are written out, and laws with their article of speech.
LONG_NAMES = {
    "REsp": "Recurso Especial", "AREsp": "Agravo em Recurso Especial", "RE": "Recurso Extraordinário", "HC": "Habeas Corpus", "RHC": "Recurso em Habeas Corpus", "MS": "Mandado de Segurança",
    "RMS": "Recurso em Mandado de Segurança", "Rcl": "Reclamação", "APL": "Apelação", "AgRg": "Agravo Regimental", "AgInt": "Agravo Interno", "EDcl": "Embargos de Declaração", "RR": "Recurso de Revista",
}
LAW_NAMES = {
    "CF-1988": "da Constituição Federal", "LEI-13105-2015": "do CPC", "DL-5452-1943": "da CLT", "LEI-8078-1990": "do Código de Defesa do Consumidor", "DL-1001-1969": "do Código Penal Militar",
    "LEI-4737-1965": "do Código Eleitoral", "LEI-10406-2002": "do Código Civil", "DL-3689-1941": "do Código de Processo Penal", "LC-64-1990": "da Lei Complementar nº 64/1990",
    "LEI-9504-1997": "da Lei nº 9.504/1997", "LEI-13467-2017": "da Lei nº 13.467/2017",
}
MARKS = ["nº", "n.", "n°", ""]
PARTS_OF_ARTICLES = ["", "", ", § 2º", ", II", ", IV"]
#: Sentences without any citation, some of which look as if they had one; and what stands before and after one.
DISTRACTORS = [
    "A parte autora juntou documentos aos autos.", "O pedido foi instruído com procuração e comprovantes.", "Não houve manifestação no prazo assinado.", "Vejam-se as fls. 31/44 do volume anexo.",
    "O requerimento 2021.7654321 aguarda despacho.", "A orientação da casa é conhecida e não foi impugnada.",
]
OPENINGS = ["Nesse sentido decidiu-se em ", "Confira-se, por oportuno, ", "Aplica-se ao caso ", "A matéria foi examinada em ", "O voto apoia-se em "]
CLOSINGS = [", como já se expôs.", ", e nada há a acrescentar.", "; a conclusão não muda.", "."]
NAMES = ["Exemplo Silva", "Modelo de Souza", "Amostra Pereira"]
HEADER = "PARECER JURÍDICO\n\n"

_ROW = ("id", "number", "case_class", "appeal_chain", "state", "court", "law_key", "article", "states", "classes")


def _pick(options: list[str], *keys: Column | str | int) -> Column:
    return F.get(F.array(*map(F.lit, options)), drawn(len(options), *keys).cast("int"))


def places(pairs: DataFrame, seed: int) -> DataFrame:
    """pair, place, kind: five to nine paragraphs for each row of ``pairs``, three of them at least with a citation, about two thirds of the rest."""
    paragraphs = pairs.select("pair").withColumn("place", F.explode(F.sequence(F.lit(0), 4 + drawn(5, "pair", seed).cast("int"))))
    kind = weighted_choice(drawn(sum(KINDS.values()), "pair", "place", seed, 1), KINDS)
    cites = (F.col("place") < 3) | (drawn(3, "pair", "place", seed, 2) > 0)
    return paragraphs.withColumn("kind", F.when(cites, kind))


def drawable(registry: DataFrame) -> DataFrame:
    """pool, bucket, row: for every pool and bucket one row of the registry, taken round the clock of the buckets that have one.

    ``states`` and ``classes`` are those of all rulings of the row's number.
    """
    rulings = registry.where("nature = 'acordao' AND number IS NOT NULL AND case_class IS NOT NULL")
    stated = rulings.groupBy("number").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("state")).alias("states"), F.array_sort(F.collect_set("case_class")).alias("classes"))
    staged = F.col("case_class").isin([c for f in CLASS_FAMILIES for c in f])
    of_number = rulings.join(stated, "number").withColumn("pool", F.explode(F.array_compact(F.array(F.lit("ruling"), F.when(F.col("n") > 1, "shared"), F.when((F.col("n") == 1) & staged, "staged")))))
    none = F.array().cast("array<string>")
    holdings = registry.where("nature = 'sumula' AND number IS NOT NULL AND court IS NOT NULL").withColumn("pool", F.lit("holding"))
    articles = registry.where((F.col("nature") == "dispositivo") & F.col("law_key").isin(*LAW_NAMES) & F.col("article").isNotNull()).withColumn("pool", F.lit("article"))
    every = of_number.select("pool", *_ROW).unionByName(holdings.unionByName(articles).withColumns({"states": none, "classes": none}).select("pool", *_ROW))
    own = every.withColumn("own", drawn(BUCKETS, "id").cast("int")).groupBy("pool", "own").agg(F.min_by(F.struct(*_ROW), "id").alias("row"))
    clock = own.select("pool").distinct().withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(2 * BUCKETS - 1))))
    order = Window.partitionBy("pool").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = own.withColumnRenamed("pool", "own_pool")
    filled = clock.join(owned, (F.col("pool") == F.col("own_pool")) & (F.col("own") == F.pmod("at", F.lit(BUCKETS))), "left").withColumn("row", F.last("row", True).over(order))
    return filled.where(F.col("at") >= BUCKETS).select("pool", (F.col("at") - BUCKETS).alias("bucket"), "row")


def _digits(length: Column, *keys: Column | str | int) -> Column:
    """A number of so many digits (30 at most), the first one not 0."""
    rest = F.concat(*(F.lpad(drawn(10**9, *keys, 100 + k).cast("string"), 9, "0") for k in range(4)))
    return F.concat((1 + drawn(9, *keys, 99)).cast("string"), F.substring(rest, 1, 29)).substr(F.lit(1), length)


def free_keys(wanted: DataFrame, registry: DataFrame, seed: int) -> DataFrame:
    """pair, place, free: the first of ``ATTEMPTS`` drawn numbers (or law and article) that no record has; nothing where all are taken."""
    tried = wanted.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(ATTEMPTS - 1))))
    keys = ("pair", "place", seed, "attempt")
    article = F.concat_ws("|", _pick([*LAW_NAMES], "pair", "place", seed, 11), (1 + drawn(2100, *keys, 12)).cast("string"))
    tried = tried.withColumn("key", F.when(F.col("kind") == "inventada_numero", _digits(F.length("row.number"), *keys)).when(F.col("kind") == "sumula_inventada", F.concat(F.lit("S"), 1 + drawn(999, *keys, 13))).otherwise(article))
    numbers, laws = registry.select(F.col("number").alias("key")), registry.select(F.concat_ws("|", "law_key", "article").alias("key"))
    left = tried.select("pair", "place", "attempt", "key").join(numbers.unionByName(laws).where("key <> ''"), "key", "left_anti")
    return left.groupBy("pair", "place").agg(F.min_by("key", "attempt").alias("free"))


def citations(registry: DataFrame, pairs: DataFrame, seed: int) -> DataFrame:
    """pair, place, kind, surface, form, verdict, canonical_id; paragraphs without a citation have null kinds.

    A kind that the registry has no row for, or no free number, makes none.
    """
    planned = places(pairs, seed).withColumn("pool", F.element_at(_map(POOLS), F.col("kind"))).withColumn("bucket", drawn(BUCKETS, "pair", "place", seed, 3).cast("int"))
    rows = planned.join(F.broadcast(drawable(registry)), ["pool", "bucket"], "left")
    wanted = rows.where(F.col("kind").isin("inventada_numero", "sumula_inventada", "lei_inventada")).select("pair", "place", "kind", "row")
    rows = rows.join(free_keys(wanted, registry, seed), ["pair", "place"], "left")
    dealt = F.transform(F.sequence(F.lit(0), F.lit(DEALT - 1)), lambda k: drawn(2**31, "pair", "place", seed, F.lit("dealt"), k))
    made = _chosen(rows.withColumn("dealt", dealt)).withColumn("made", _made()).select("pair", "place", "kind", "made.*")
    made = made.withColumn("kind", F.when(F.col("surface").isNotNull(), F.col("kind"))).withColumn("cite_id", F.concat_ws(":", "pair", "place"))
    looked_up = F.col("kind").isNotNull() & (F.col("kind") != "sem_numero")
    out = truth(made.withColumn("key", F.when(looked_up, F.coalesce("key", F.lit("")))), registry, keep=("pair", "place", "kind", "surface"))
    form = F.coalesce(F.element_at(_map(FORMS), F.col("kind")), F.lit("com_numero"))
    cited = F.col("kind").isNotNull()
    return out.select("pair", "place", "kind", "surface", *(F.when(cited, c).alias(name) for name, c in (("form", form), ("verdict", F.col("verdict")), ("canonical_id", F.col("canonical_id")))))


def _dealt(k: int, modulus: int = 2**31) -> Column:
    """The k-th of the numbers that a place was dealt, below ``modulus``."""
    return F.get("dealt", k) % modulus


def _of(options: list[str], k: int) -> Column:
    return F.get(F.array(*map(F.lit, options)), _dealt(k, len(options)).cast("int"))


def _one(options: Column, k: int) -> Column:
    return F.when(F.size(options) > 0, F.get(options, (_dealt(k) % F.size(options)).cast("int")))


def _map(of: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in of.items() for x in pair))


def _chosen(rows: DataFrame) -> DataFrame:
    """What each place's citation is of: number, class, chain, state and whether it must be shown; holding and court; law and article."""
    kind, row, free = F.col("kind"), F.col("row"), F.col("free")
    none = F.array().cast("array<string>")
    used, taken = F.coalesce(row["states"], none), F.coalesce(row["classes"], none)
    elsewhere = F.filter(F.array(*map(F.lit, dims.STATES)), lambda s: ~F.array_contains(used, s))
    near = F.flatten(F.transform(taken, lambda c: F.coalesce(F.element_at(_family_map(), c), none)))
    outside = F.filter(F.array(*map(F.lit, LONG_NAMES)), lambda c: ~F.array_contains(taken, c) & ~F.array_contains(near, c))
    stage = F.filter(F.coalesce(F.element_at(_family_map(), row["case_class"]), none), lambda c: c != row["case_class"])
    moved = (kind == "emprestada") & row["state"].isNotNull() & (row["court"] != "TST") & (_dealt(0, 2) == 0)
    recast = (kind == "emprestada") & ~moved
    other = kind == "mesmo_caso_outro_estagio"
    binding = row["number"].startswith("SV")
    borrowed = (kind == "sumula_inventada") & (_dealt(1, 2) == 0) & ~F.coalesce(binding, F.lit(True))
    invented = kind == "inventada_numero"
    return rows.withColumns(
        {
            "moved": F.coalesce(moved, F.lit(False)),
            "c_number": F.when(invented, free).otherwise(row["number"]),
            "c_class": F.when(recast, _one(outside, 2)).when(other, _one(stage, 3)).otherwise(row["case_class"]),
            "c_chain": F.when(F.coalesce(moved, F.lit(False)) | kind.isin("real_acordao", "inventada_numero"), row["appeal_chain"]).otherwise(none),
            "c_state": F.when(moved, _one(elsewhere, 4)).when(kind != "ambigua", row["state"]),
            "h_number": F.when((kind == "real_sumula") | borrowed, row["number"]).otherwise(free),
            "h_court": F.when(kind == "real_sumula", row["court"]).when(borrowed, _one(F.filter(F.array(*map(F.lit, dims.COURTS)), lambda c: c != row["court"]), 5)).otherwise(_of([*dims.COURTS], 6)),
            "law": F.when(kind == "real_lei", row["law_key"]).otherwise(F.substring_index(free, "|", 1)),
            "article": F.when(kind == "real_lei", row["article"]).when(kind == "lei_inventada", F.substring_index(free, "|", -1)).otherwise((1 + _dealt(7, 400)).cast("string")),
        }
    )


def _made() -> Column:
    """surface, and what it states: key, court, state, case_class, appeal_chain; null where a kind can't be made."""
    kind, number = F.col("kind"), F.col("c_number")
    none, nothing = F.array().cast("array<string>"), F.lit(None).cast("string")

    def stated(surface: Column, key: Column, court: Column = nothing, state: Column = nothing, case_class: Column = nothing, chain: Column = none) -> Column:
        return F.when(surface.isNotNull(), F.struct(surface.alias("surface"), key.alias("key"), court.alias("court"), state.alias("state"), case_class.alias("case_class"), chain.alias("appeal_chain")))

    labour, named = (F.col("row.court") == "TST") & (F.length(number) >= 14), _dealt(8, 100) < 80
    every = F.concat("c_chain", F.array("c_class"))
    token = F.concat(F.when(named, "TST-").otherwise(""), F.array_join(every, "-"), F.lit("-"), masked(number))
    names = F.array_join(F.transform(every, lambda c: F.when(_dealt(9, 100) < 40, F.coalesce(F.element_at(_map(LONG_NAMES), c), c)).otherwise(c)), " no ")
    mark = F.when(F.length(number) < 4, F.lit(" nº ")).otherwise(F.get(F.array(*(F.lit(f" {m} ".replace("  ", " ")) for m in MARKS)), _dealt(10, len(MARKS)).cast("int")))
    shown = F.when(F.length(number) >= 14, masked(number)).when((F.length(number) > 3) & (_dealt(11, 100) < 70), with_thousands(number)).otherwise(number)
    said = F.col("c_state").isNotNull() & (F.col("moved") | (_dealt(12, 100) < 70))
    where = F.when(said, F.replace(_of(["/UF", " - UF", " (UF)"], 13), F.lit("UF"), F.col("c_state"))).otherwise("")
    ruling = F.when(labour, stated(token, number, F.when(named, "TST"), nothing, F.col("c_class"), F.col("c_chain"))).otherwise(stated(F.concat(names, mark, shown, where), number, nothing, F.when(said, F.col("c_state")), F.col("c_class"), F.col("c_chain")))

    binding, digits = F.col("h_number").startswith("SV"), F.regexp_replace("h_number", "[^0-9]", "")
    holding = F.concat(F.when(binding, "Súmula Vinculante ").when(kind == "sumula_inventada", "Súmula ").otherwise(_of(["Súmula ", "Súmula n. ", "SÚMULA "], 14)), digits, F.lit(" do "), F.col("h_court"))
    n = F.col("article")
    article = F.when((F.length(n) == 1) & (_dealt(15, 2) == 0), F.concat(n, F.lit("º"))).when(F.length(n) > 3, with_thousands(n)).otherwise(n)
    of_law = F.concat(_of(["art. ", "artigo "], 16), article, _of(PARTS_OF_ARTICLES, 17), F.lit(" "))
    law_number, law_year = (1000 + _dealt(18, 99000)).cast("string"), (1950 + _dealt(19, 75)).cast("string")
    court, when, name = _of([*dims.COURTS], 20), (2009 + _dealt(21, 17)).cast("string"), _of(NAMES, 22)
    unnumbered = F.get(F.array(*map(F.lit, ("acórdão do COURT de YEAR, Rel. Min. NAME", "decisão do COURT, de YEAR, relator o Ministro NAME", "precedente do COURT (Rel. Min. NAME, YEAR)"))), _dealt(23, 3).cast("int"))
    for word, value in (("COURT", court), ("YEAR", when), ("NAME", name)):
        unnumbered = F.replace(unnumbered, F.lit(word), value)
    theme = F.concat(F.lit("Tema "), with_thousands((1 + _dealt(24, 1300)).cast("string")), F.lit(" da repercussão geral"))
    return (
        F.when(kind.isin("real_acordao", "inventada_numero", "emprestada", "mesmo_caso_outro_estagio", "ambigua"), ruling)
        .when(kind.isin("real_sumula", "sumula_inventada"), stated(holding, F.col("h_number"), F.col("h_court")))
        .when(kind.isin("real_lei", "lei_inventada"), stated(F.concat(of_law, F.element_at(_map(LAW_NAMES), F.col("law"))), F.concat_ws("|", "law", "article")))
        .when(kind == "lei_desconhecida", stated(F.concat(of_law, F.lit("da Lei nº "), with_thousands(law_number), F.lit("/"), law_year), F.concat(F.lit("LEI-"), law_number, F.lit("-"), law_year, F.lit("|"), n)))
        .when(kind == "sem_numero", stated(unnumbered, nothing))
        .when(kind == "tema", stated(theme, F.lit("")))
    )


def _family_map() -> Column:
    """Each class with the classes that share a family with it."""
    near: dict[str, list[str]] = {}
    for family in CLASS_FAMILIES:
        for c in family:
            near[c] = sorted({*near.get(c, []), *family})
    return F.create_map(*(x for c, all_ in near.items() for x in (F.lit(c), F.array(*map(F.lit, all_)))))


def paragraphs(cited: DataFrame, seed: int) -> DataFrame:
    """The paragraphs of both twins of ``citations``: doc_id, pair, place, noisy, kind, lead, shown (its citation), paragraph, form, verdict, canonical_id."""
    twins = cited.withColumn("noisy", F.explode(F.array(F.lit(False), F.lit(True))))
    keys = ("pair", "place", seed)
    shown = F.when(F.col("noisy"), noised(F.col("surface"), *keys)["text"]).otherwise(F.col("surface"))
    idle = _pick(DISTRACTORS, *keys, 50)
    cites = F.col("kind").isNotNull()
    before = F.when(drawn(100, *keys, 51) < 40, F.concat(idle, F.lit(" "))).otherwise("")
    after = F.when(drawn(100, *keys, 52) < 40, F.concat(F.lit(" "), _pick(DISTRACTORS, *keys, 53))).otherwise("")
    parts = twins.withColumn("shown", shown).withColumn("lead", F.when(cites, F.concat(before, _pick(OPENINGS, *keys, 54))).otherwise(idle))
    parts = parts.withColumn("paragraph", F.when(cites, F.concat("lead", "shown", _pick(CLOSINGS, *keys, 55), after, F.lit("\n\n"))).otherwise(F.concat("lead", F.lit("\n\n"))))
    parts = parts.withColumn("doc_id", F.format_string("%06d%s", F.col("pair").cast("long"), F.when(F.col("noisy"), "_r").otherwise("_l")))
    return parts.select("doc_id", "pair", "place", "noisy", "kind", "lead", "shown", "paragraph", "form", "verdict", "canonical_id")


def written(cited: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, pair, noisy, text) and (doc_id, pair, place, noisy, kind, start, end, snippet, form, verdict, canonical_id) of ``citations``: two documents a pair."""
    return assembled(paragraphs(cited, seed))


def assembled(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and gold labels of ``paragraphs``, which both are made of: whoever needs both keeps them."""
    order = Window.partitionBy("doc_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("at", F.coalesce(F.sum(F.length("paragraph")).over(order), F.lit(0)) + len(HEADER))
    start = F.col("at") + F.length("lead")
    gold = placed.where("kind IS NOT NULL").select("doc_id", "pair", "place", "noisy", "kind", start.cast("int").alias("start"), (start + F.length("shown")).cast("int").alias("end"), F.col("shown").alias("snippet"), "form", "verdict", "canonical_id")
    items = F.array_sort(F.collect_list(F.struct("place", "paragraph")))
    text = F.concat(F.lit(HEADER), F.array_join(F.transform(items, lambda x: x["paragraph"]), ""))
    return parts.groupBy("doc_id", "pair", "noisy").agg(text.alias("text")), gold


def documents(spark: SparkSession, registry: DataFrame, n_docs: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Documents and gold labels of ``n_docs`` pairs."""
    return written(citations(registry, spark.range(n_docs).withColumnRenamed("id", "pair"), seed), seed)
