"""The verification itself over citations that are written into texts from the given tables; SQL says what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.operators.decide import decide, is_broken
from citeflow.operators.fields import classes_in, labour_classes, law_key, state
from citeflow.operators.normalise import with_norm
from citeflow.operators.parse_registry import parse_registry
from citeflow.plans.catalog import query, table
from citeflow.sources.runs import content_sums
from citeflow.plans.verify import LOOKED_UP, extract, prepare, verify, with_fields

#: Written before and after each citation; the header is one line of capitals and one with a label.
HEAD, BEFORE, AFTER = "PARECER DO RELATOR\nProcesso nº 77\n", "Conforme se viu em ", ", nega-se o pedido."


def _dotted(number: Column) -> Column:
    n = number.cast("string")
    return F.concat_ws(".", F.substring(n, 1, 1), F.substring(n, 2, 3), F.substring(n, 5, 3))


def _state(key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ("SP", "RJ", "MG", "BA"))), (key % 4 + 1).cast("int"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: one citation for each order, of the kind that its key asks for, some of them as a scan misreads them."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    number = k % 1000000 + 1000000
    dotted, small = _dotted(number), (k % 900 + 100).cast("string")
    labour = F.concat(F.lit("TST-AIRR-"), number.cast("string"), F.lit("-78.2015.5.24.0091"))
    written = [
        F.concat(F.lit("REsp nº "), dotted, F.lit("/"), _state(c)),
        F.concat(F.lit("AgRg no AREsp n° l"), F.substring(dotted, 2, 20), F.lit(" – "), _state(c)),
        F.concat(F.lit("Súmula nº "), small, F.lit(" do STJ")),
        F.concat(F.lit("art. "), small, F.lit(", § 1º, do CPC")),
        F.lit("acórdão do STJ de 2019, Rel. Min. Ana Modelo"),
        labour,
        F.concat(F.lit("5úrnula "), small, F.lit(" do STJ")),
        F.lit("jurisprudência pacífica"),
    ]
    kind = (k % 8).cast("int")
    citation = F.element_at(F.array(*written), kind + 1)
    # the keys are dealt out before texts are made of them: the table may be one split, and the kernel works split by split
    keys = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    return keys.select(k.alias("doc_id"), F.concat(F.lit(HEAD + BEFORE), citation, F.lit(AFTER)).alias("text"))


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry sources: a ruling for every third order, in another state for every fifth, and precedents and articles."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    number = k % 1000000 + 1000000
    where = F.when(k % 5 == 0, "PR").otherwise(_state(c))
    header = F.concat(F.lit("AgRg no AGRAVO EM RECURSO ESPECIAL Nº "), _dotted(number), F.lit(" - "), where, F.lit(" (2018/0169803-4)\nRELATORA : MINISTRA ANA MODELO  AGRAVANTE : FULANO"))
    plain = F.concat(F.lit("RECURSO ESPECIAL Nº "), _dotted(number), F.lit(" - "), where, F.lit(" (2017/0169803-4)\nRELATOR : MINISTRO CAIO MODELO  RECORRENTE : FULANO"))
    labour = F.concat(F.lit("estes autos de Agravo TST-AIRR-"), number.cast("string"), F.lit("-78.2015.5.24.0091, em que é agravante"))
    # dealt out as in _texts: headers are read split by split
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").where(k % 3 == 0).repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    rulings = orders.select(
        F.concat(F.lit("r"), k).alias("id"), F.when(k % 8 == 5, "TST").otherwise("STJ").alias("tribunal"), F.lit("acordao").alias("natureza"), F.when(k % 8 == 5, labour).when(k % 8 == 1, header).otherwise(plain).alias("texto")
    )
    n = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").where((n >= 100) & (n < 1000))
    holdings = parts.where(n % 2 == 0).select(F.concat(F.lit("s"), n), F.lit("STJ"), F.lit("sumula"), F.concat(F.lit("Súmula n. "), n, F.lit(" do STJ")))
    articles = parts.where(n % 3 == 0).select(F.concat(F.lit("a"), n), F.lit(None).cast("string"), F.lit("dispositivo"), F.concat(F.lit("Artigo "), n, F.lit("º da Lei nº 13.105, de 16 de março de 2015\ncorpo")))
    every = rulings.unionAll(holdings).unionAll(articles)
    return every.select("id", "tribunal", F.lit(None).cast("int").alias("ano"), F.lit(None).cast("string").alias("relator"), "natureza", "texto")


_WRITTEN = f"""
k AS (
  SELECT o_orderkey AS doc_id, o_orderkey % 8 AS kind, o_orderkey % 1000000 + 1000000 AS number, o_orderkey % 900 + 100 AS small,
         ['SP', 'RJ', 'MG', 'BA'][o_custkey % 4 + 1] AS st, {len(HEAD + BEFORE)} AS start_at FROM orders
), w AS (
  SELECT *, substr(CAST(number AS VARCHAR), 1, 1) || '.' || substr(CAST(number AS VARCHAR), 2, 3) || '.' || substr(CAST(number AS VARCHAR), 5, 3) AS dotted FROM k
), c AS (
  SELECT *, CASE kind
    WHEN 0 THEN 'REsp nº ' || dotted || '/' || st
    WHEN 1 THEN 'AgRg no AREsp n° l' || substr(dotted, 2) || ' – ' || st
    WHEN 2 THEN 'Súmula nº ' || small || ' do STJ'
    WHEN 3 THEN 'art. ' || small || ', § 1º, do CPC'
    WHEN 4 THEN 'acórdão do STJ de 2019, Rel. Min. Ana Modelo'
    WHEN 5 THEN 'TST-AIRR-' || number || '-78.2015.5.24.0091'
    WHEN 6 THEN '5úrnula ' || small || ' do STJ'
    ELSE 'jurisprudência pacífica' END AS snippet,
  CASE kind WHEN 0 THEN 'com_numero' WHEN 1 THEN 'com_numero' WHEN 2 THEN 'sumula' WHEN 3 THEN 'lei_artigo' WHEN 4 THEN 'sem_numero' WHEN 5 THEN 'com_numero' WHEN 6 THEN 'sumula' ELSE 'referencia_vaga' END AS form FROM w
)"""


@query(
    f"""WITH {_WRITTEN}
SELECT doc_id, CAST(length('{HEAD + BEFORE + AFTER}') + length(snippet) - CASE kind WHEN 1 THEN 2 WHEN 6 THEN 1 ELSE 0 END AS INTEGER) AS n_norm,
       '{HEAD.replace(chr(10), " ")}{BEFORE}' || CASE kind
         WHEN 1 THEN 'AgRg no AREsp nº ' || dotted || '-' || st WHEN 6 THEN 'Súmula ' || small || ' do STJ' ELSE snippet END || '{AFTER}' AS norm,
       kind IN (1, 6) AS moved,
       CAST(CASE kind WHEN 1 THEN start_at + length(snippet) - 1 WHEN 6 THEN start_at + length(snippet) - 1 END AS INTEGER) AS last_at
FROM c"""
)
def normalised_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised texts; where positions moved, the original place of the citation's last sign."""
    norm = with_norm(_texts(spark, sf_dir))
    last = F.get("map", F.length("norm") - len(AFTER) - 1)
    return norm.select("doc_id", F.length("norm").alias("n_norm"), "norm", F.col("map").isNotNull().alias("moved"), last.alias("last_at"))


@query(f"WITH {_WRITTEN} SELECT doc_id, CAST(start_at AS INTEGER) AS start, CAST(start_at + length(snippet) AS INTEGER) AS \"end\", form, snippet FROM c")
def citation_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(prepare(_texts(spark, sf_dir)), with_vague=True).select("doc_id", "start", "end", "form", "snippet")


@query(
    f"""WITH {_WRITTEN}
SELECT doc_id, CASE WHEN kind IN (2, 4, 6) THEN 'STJ' WHEN kind = 5 THEN 'TST' END AS court,
       CASE kind WHEN 0 THEN 'REsp' WHEN 1 THEN 'AREsp' WHEN 5 THEN 'AIRR' END AS case_class, CASE kind WHEN 1 THEN 'AgRg' ELSE '' END AS chain,
       CASE WHEN kind IN (0, 1) THEN CAST(number AS VARCHAR) WHEN kind IN (2, 6) THEN 'S' || small WHEN kind = 5 THEN number || '7820155240091' END AS number,
       CASE WHEN kind IN (0, 1) THEN st END AS state, CAST(CASE kind WHEN 4 THEN 2019 END AS INTEGER) AS year, CASE kind WHEN 4 THEN 'ana modelo' END AS relator,
       CASE kind WHEN 3 THEN 'LEI-13105-2015' END AS law_key, CASE kind WHEN 3 THEN CAST(small AS VARCHAR) END AS article,
       false AS ocr_fixed
FROM c"""
)
def citation_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = with_fields(extract(prepare(_texts(spark, sf_dir)), with_vague=True))
    plain = [F.col(f"fields.{c}").alias(c) for c in ("court", "case_class", "number", "state", "year", "relator", "law_key", "article", "ocr_fixed")]
    return read.select("doc_id", F.array_join("fields.appeal_chain", " ").alias("chain"), *plain)


_REGISTRY = """
o AS (SELECT *, o_orderkey % 1000000 + 1000000 AS number, o_orderkey % 8 AS kind FROM orders WHERE o_orderkey % 3 = 0), r AS (
  SELECT 'r' || o_orderkey AS id, 'acordao' AS nature, CASE kind WHEN 5 THEN 'TST' ELSE 'STJ' END AS court,
         CASE kind WHEN 5 THEN number || '7820155240091' ELSE CAST(number AS VARCHAR) END AS number,
         CASE kind WHEN 5 THEN 'AIRR' WHEN 1 THEN 'AREsp' ELSE 'REsp' END AS case_class, CASE kind WHEN 1 THEN 'AgRg' ELSE '' END AS chain,
         CASE WHEN kind = 5 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'PR' ELSE ['SP', 'RJ', 'MG', 'BA'][o_custkey % 4 + 1] END AS state,
         CAST(CASE kind WHEN 5 THEN 2015 WHEN 1 THEN 2018 ELSE 2017 END AS INTEGER) AS year,
         CASE kind WHEN 5 THEN NULL WHEN 1 THEN 'ana modelo' ELSE 'caio modelo' END AS relator, CAST(NULL AS VARCHAR) AS law_key, CAST(NULL AS VARCHAR) AS article FROM o
  UNION ALL SELECT 's' || p_partkey, 'sumula', 'STJ', 'S' || p_partkey, NULL, '', NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey BETWEEN 100 AND 999 AND p_partkey % 2 = 0
  UNION ALL SELECT 'a' || p_partkey, 'dispositivo', NULL, NULL, NULL, '', NULL, NULL, NULL, 'LEI-13105-2015', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey BETWEEN 100 AND 999 AND p_partkey % 3 = 0
)"""


@query(f"WITH {_REGISTRY} SELECT * FROM r")
def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_registry(_source(spark, sf_dir))
    return rows.select("id", "nature", "court", "number", "case_class", F.array_join("appeal_chain", " ").alias("chain"), "state", "year", "relator", "law_key", "article")


_DECIDED = f"""
WITH {_WRITTEN}, {_REGISTRY}, cand AS (
  SELECT doc_id, r.id, r.state IS NULL OR kind = 5 OR r.state = st OR kind IN (2, 3, 6) AS fits,
         r.case_class AS theirs, CASE kind WHEN 0 THEN 'REsp' WHEN 1 THEN 'AREsp' WHEN 5 THEN 'AIRR' END AS ours, kind,
         count(*) OVER (PARTITION BY doc_id) AS n
  FROM c JOIN r ON (kind IN (0, 1) AND r.number = CAST(c.number AS VARCHAR)) OR (kind = 5 AND r.number = c.number || '7820155240091') OR (kind IN (2, 6) AND r.number = 'S' || small)
    OR (kind = 3 AND r.article = CAST(small AS VARCHAR))
), agg AS (
  SELECT doc_id, count(*) AS n_candidates, count(*) FILTER (WHERE ok) AS n_consistent, min(id) FILTER (WHERE ok) AS only_id,
         string_agg(id, ',' ORDER BY id) AS candidates, coalesce(string_agg(id, ',' ORDER BY id) FILTER (WHERE ok), '') AS consistent
  FROM (SELECT *, fits AND (theirs IS NULL OR ours = theirs OR n = 1) AS ok FROM cand) GROUP BY doc_id
), p AS (
  SELECT c.doc_id, c.start_at, c.snippet, c.form, kind, coalesce(n_candidates, 0) AS n_candidates, coalesce(n_consistent, 0) AS n_consistent, only_id, coalesce(candidates, '') AS candidates, coalesce(consistent, '') AS consistent,
         CASE WHEN kind = 4 THEN 'sem_numero' WHEN kind = 7 THEN 'referencia_vaga'
              WHEN n_candidates IS NULL THEN CASE kind WHEN 3 THEN 'lei_ausente' ELSE 'numero_ausente' END
              WHEN n_consistent = 0 THEN 'numero_contradito' WHEN n_consistent > 1 THEN CASE kind WHEN 3 THEN 'lei_ambigua' ELSE 'numero_ambiguo' END
              WHEN kind = 3 THEN 'lei_unica' WHEN n_candidates > 1 THEN 'numero_desempatado' ELSE 'numero_unico' END AS path
  FROM c LEFT JOIN agg ON c.doc_id = agg.doc_id
), v AS (
  SELECT *, CASE WHEN path IN ('lei_unica', 'numero_unico', 'numero_desempatado') THEN 'real' WHEN path IN ('sem_numero', 'referencia_vaga', 'lei_ambigua', 'numero_ambiguo') THEN 'incompleta' ELSE 'inventada' END AS verdict FROM p
)"""


@query(
    f"""{_DECIDED}
SELECT doc_id, CAST(start_at AS INTEGER) AS start, CAST(start_at + length(snippet) AS INTEGER) AS "end", snippet, form, CASE kind WHEN 3 THEN 'lei' ELSE 'jurisprudencia' END AS type, path, verdict, CASE verdict WHEN 'real' THEN only_id END AS canonical_id FROM v"""
)
def verified_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from texts and registry sources to verdicts."""
    return verify(_texts(spark, sf_dir), parse_registry(_source(spark, sf_dir)), with_vague=True).drop("fields")


def _decided(spark: SparkSession, sf_dir: str, with_ids: bool) -> DataFrame:
    read = with_fields(extract(prepare(_texts(spark, sf_dir)), with_vague=True))
    asked = read.select(F.col("doc_id").alias("mention_id"), "form", F.col("fields").isNotNull().alias("fields_read"), *(F.col(f"fields.{c}").alias(c) for c in LOOKED_UP))
    return decide(asked, parse_registry(_source(spark, sf_dir)), with_ids=with_ids, with_record=True)


@query(f"{_DECIDED} SELECT doc_id, path, CAST(n_candidates AS BIGINT) AS n_candidates, CAST(n_consistent AS BIGINT) AS n_consistent, candidates, consistent FROM v")
def decision_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the records that each decision weighed, and of those that nothing contradicts."""
    listed = [F.array_join(c, ",").alias(c) for c in ("candidates", "consistent")]
    return _decided(spark, sf_dir, with_ids=True).select(F.col("mention_id").alias("doc_id"), "path", "n_candidates", F.coalesce("n_consistent", F.lit(0)).alias("n_consistent"), *listed)


@query("SELECT CAST(0 AS BIGINT) AS broken, count(*) AS decided FROM orders")
def decision_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir, with_ids=False).agg(F.coalesce(F.count_if(is_broken(with_record=True)), F.lit(0)).alias("broken"), F.count("*").alias("decided"))


@query("""
SELECT unnest(['other names', 'other partitions', 'other order']) AS change, n, true AS same FROM (SELECT count(*) AS n FROM orders)
""")
def verification_is_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents under other names, in other partitions and in another order give the same mentions and verdicts."""
    docs, rows = _texts(spark, sf_dir), parse_registry(_source(spark, sf_dir))
    name = F.col("doc_id").cast("string")
    changes = {
        "other names": docs.withColumn("doc_id", F.concat(F.md5(name.cast("binary")), F.lit("-"), name)),
        "other partitions": docs.repartition(5, F.xxhash64("text")),
        "other order": docs.sortWithinPartitions(F.desc("text")),
    }

    def sums(given: DataFrame) -> DataFrame:
        found = verify(given, rows, with_vague=True)
        return content_sums(found.withColumn("doc_id", F.element_at(F.split(F.col("doc_id").cast("string"), "-"), -1)).drop("fields"))

    base = sums(docs).withColumnsRenamed({c: f"b_{c}" for c in ("n", "first", "second")})
    out = None
    for change, given in changes.items():
        one = sums(given).select(F.lit(change).alias("change"), "*")
        out = one if out is None else out.unionByName(one)
    same = (F.col("n") == F.col("b_n")) & (F.col("first") == F.col("b_first")) & (F.col("second") == F.col("b_second"))
    return out.join(F.broadcast(base)).select("change", "n", same.alias("same"))  # one row with each


@query("""
WITH a AS (SELECT p_partkey, ['AgRg', 'REsp', 'HC', 'AgInt', 'MS'][p_partkey % 5 + 1] AS x, ['Rcl', 'RE', 'AREsp', 'RMS'][p_size % 4 + 1] AS y FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN x || ' ' || y ELSE x END AS classes FROM a
""")
def class_list_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All class names of a text in their order, written as names or acronyms."""
    names = {"AgRg": "agravo regimental", "REsp": "recurso especial", "HC": "habeas corpus", "AgInt": "Ag. Int.", "MS": "mandado de segurança", "Rcl": "reclamação", "RE": "recurso extraordinário", "AREsp": "agravo em recurso especial", "RMS": "rms"}

    def pick(of: list[str], at: Column) -> Column:
        return F.element_at(F.array(*(F.lit(names[c]) for c in of)), (at % len(of) + 1).cast("int"))

    first, second = pick(["AgRg", "REsp", "HC", "AgInt", "MS"], F.col("p_partkey")), pick(["Rcl", "RE", "AREsp", "RMS"], F.col("p_size"))
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("veja o "), first, F.lit(" na "), second)).otherwise(F.concat(first, F.lit(" qualquer")))
    return table(spark, sf_dir, "part").withColumn("__text", text).select("p_partkey", F.array_join(classes_in("__text"), " ").alias("classes"))


@query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'LEI-13105-2015' WHEN 1 THEN 'LEI-' || p_partkey || '-1998' WHEN 2 THEN 'LC-' || p_partkey || '-2001' WHEN 3 THEN 'DL-' || p_partkey || '-1943' WHEN 4 THEN 'CF-1988' END AS law,
       ['AgRg RR', 'AIRR', 'XYZ Ag'][p_size % 3 + 1] AS classes FROM part
""")
def law_and_token_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws by name or by number and year, and the classes of a labour number's tokens."""
    n = F.col("p_partkey").cast("string")
    named = [F.lit("Código de  Processo Civil"), F.concat(F.lit("Lei nº "), n, F.lit(", de 9 de maio de 1998")), F.concat(F.lit("LC n. "), n, F.lit("/2001")), F.concat(F.lit("Decreto-Lei nº "), n, F.lit(" / 1943")), F.lit("Constituição da República"), F.lit("Estatuto do Clube")]
    tokens = F.element_at(F.array(*map(F.lit, ("TST-AgRR-", "TST-AIRR-", "XYZ-A-"))), (F.col("p_size") % 3 + 1).cast("int"))
    law = law_key(F.element_at(F.array(*named), (F.col("p_partkey") % 6 + 1).cast("int")))
    return table(spark, sf_dir, "part").select("p_partkey", law.alias("law"), F.array_join(labour_classes(tokens), " ").alias("classes"))


@query("SELECT c_custkey, ['SP', 'RJ', NULL, 'MG', 'ES'][c_nationkey % 5 + 1] AS state FROM customer")
def state_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.element_at(F.array(*map(F.lit, ("sp", "Rio de Janeiro", "Acapulco", " MG ", "ESPÍRITO SANTO"))), (F.col("c_nationkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", state(written).alias("state"))


_RARE = [
    ("'Tema 1.' || n || ' da repercussão geral'", "com_numero", None, None, "'1' || n", None, None),
    ("'ADPF ' || n || '/DF'", "com_numero", None, "'ADPF'", "CAST(n AS VARCHAR)", "'DF'", None),
    ("'Súmulas ' || n || ', 83 e 7 do STJ'", "sumula", "'STJ'", None, "'S' || n", None, None),
    ("'Enunciado n. ' || n || ' da Súmula do TST'", "sumula", "'TST'", None, "'S' || n", None, None),
    ("'OJ ' || n || ' da SBDI-1 do TST'", "sumula", "'TST'", None, "'OJ' || n", None, None),
    ("'Súmula Vinculante ' || n || ' do STF'", "sumula", "'STF'", None, "'SV' || n", None, None),
    ("'habeas corpus nº ' || n || '.456 (SP)'", "com_numero", None, "'HC'", "n || '456'", "'SP'", None),
    ("'artigo ' || n || ', III, da Constituição Federal'", "lei_artigo", None, None, None, None, "'CF-1988'"),
    ("'segundo AgInt no Recurso em Mandado de Segurança n. ' || n || '.789'", "com_numero", None, "'RMS'", "n || '789'", None, None),
    ("'decisão do STM, de 2014, relatora a Ministra Bia Modelo'", "sem_numero", "'STM'", None, None, None, None),
    ("'Súmula ' || n || ', itens I e IV, do TST'", "sumula", None, None, "'S' || n", None, None),
    ("'art. ' || n || ' da Lei nº 9.504/1997'", "lei_artigo", None, None, None, None, "'LEI-9504-1997'"),
]


def _rare_sql() -> str:
    def case(k: int, kind: str = "VARCHAR") -> str:
        return "CASE kind " + " ".join(f"WHEN {i} THEN {row[k]}" for i, row in enumerate(_RARE) if row[k]) + f" ELSE CAST(NULL AS {kind}) END"

    forms = " ".join(f"WHEN {i} THEN '{row[1]}'" for i, row in enumerate(_RARE))
    return f"""
WITH k AS (SELECT p_partkey, p_partkey % {len(_RARE)} AS kind, 100 + p_partkey % 800 AS n FROM part), t AS (SELECT *, {case(0)} AS written FROM k)
SELECT p_partkey, 8 AS start, CAST(8 + length(written) - CASE kind WHEN 10 THEN 22 ELSE 0 END AS INTEGER) AS "end", CASE kind {forms} END AS form, {case(2)} AS court, {case(3)} AS case_class, {case(4)} AS number,
       {case(5)} AS state, {case(6)} AS law_key, CASE WHEN kind IN (7, 11) THEN CAST(n AS VARCHAR) END AS article, CAST(CASE kind WHEN 9 THEN 2014 END AS INTEGER) AS year FROM t"""


@query(_rare_sql())
def rare_citation_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Themes, constitutional control, lists of precedents, statements, guidelines, items, long class names, articles of the constitution."""
    written = " ".join(f"WHEN {i} THEN {row[0]}" for i, row in enumerate(_RARE))
    rows = table(spark, sf_dir, "part").select("p_partkey").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    rows = rows.selectExpr("p_partkey AS doc_id", f"p_partkey % {len(_RARE)} AS kind", "100 + p_partkey % 800 AS n").selectExpr("doc_id", f"'Veja-se ' || CASE kind {written} END || ', e basta.' AS text")
    read = with_fields(extract(prepare(rows)))
    return read.select(F.col("doc_id").alias("p_partkey"), "start", "end", "form", *(F.col(f"fields.{c}").alias(c) for c in ("court", "case_class", "number", "state", "law_key", "article", "year")))


@query("""
WITH k AS (SELECT s_suppkey AS k, s_suppkey % 5 AS kind, 100 + s_suppkey % 900 AS n FROM supplier)
SELECT CAST(k AS VARCHAR) AS id, ['STF', 'STM', 'TSE', 'TSE', 'TST'][kind + 1] AS court, ['RE', 'APL', 'REspe', 'REspe', 'RR'][kind + 1] AS case_class,
       CASE kind WHEN 0 THEN '1' || n || '456' WHEN 1 THEN '7000' || n || '45201970000' || '00' WHEN 2 THEN '0600' || n || '12202062600' || '00' WHEN 3 THEN '25' || n ELSE '1000' || n || '7820155240091' END AS number,
       CASE kind WHEN 0 THEN 'SP' WHEN 2 THEN 'BA' WHEN 4 THEN 'RR' END AS state, CAST(CASE kind WHEN 1 THEN 2019 WHEN 2 THEN 2020 WHEN 4 THEN 2015 END AS INTEGER) AS year,
       CASE kind WHEN 0 THEN 'fulano modelo' WHEN 1 THEN 'beltrana modelo' WHEN 2 THEN 'sicrano modelo' END AS relator, CASE kind WHEN 4 THEN 'AgRg' ELSE '' END AS chain FROM k
""")
def court_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own numbers, classes, states, years and names from headers as each court writes them, some torn apart by a scan."""
    k, n = F.col("s_suppkey"), (100 + F.col("s_suppkey") % 900).cast("string")
    kind = (k % 5).cast("int")
    heads = [
        F.concat(F.lit("RECURSO EXTRAORDINÁRIO 1."), n, F.lit(".456 SÃO PAULO RELATOR : MIN. FULANO MODELO  RECTE.(S) : ALGUÉM")),
        F.concat(F.lit("APELAÇÃO Nº 7000"), n, F.lit("-45 . 2019.7. 00.0000 RELATORA: MINISTRA BELTRANA MODELO  APELANTE: ALGUÉM")),
        F.concat(F.lit("RECURSO ESPECIAL ELEITORAL Nº 0600"), n, F.lit("-12.2020.6.26.0000 - Bahia. Relator: Ministro Sicrano Modelo  RECORRENTE: ALGUÉM")),
        F.concat(F.lit("RECURSO ESPECIAL ELEITORAL Nº 25."), n, F.lit(" (em mesa)\n")),
        F.concat(F.lit("Vistos estes autos de Agravo em Recurso de Revista TST-AgR-RR-1000"), n, F.lit("-78.2015.5.24.0091, em que é parte alguém")),
    ]
    courts = F.get(F.array(*map(F.lit, ("STF", "STM", "TSE", "TSE", "TST"))), kind)
    source = table(spark, sf_dir, "supplier").select(k.cast("string").alias("id"), courts.alias("tribunal"), F.lit(None).cast("int").alias("ano"), F.lit(None).cast("string").alias("relator"), F.lit("acordao").alias("natureza"), F.get(F.array(*heads), kind).alias("texto"))
    return parse_registry(source).select("id", "court", "case_class", "number", "state", "year", "relator", F.array_join("appeal_chain", " ").alias("chain"))


@query("""
WITH k AS (SELECT p_partkey AS doc_id, 10 + p_partkey % 90 AS n FROM part), t AS (SELECT *, 'Consta do REsp ' || n || ' e da Súmula ' AS a, n || ' do STJ' AS b FROM k)
SELECT doc_id, 10 AS start, 17 AS "end", 'com_numero' AS form, 'encoder' AS source, 'inventada' AS verdict FROM t
UNION ALL SELECT doc_id, length(a) - 7, length(a) + length(b), 'sumula', 'regras', CASE WHEN n % 2 = 0 THEN 'real' ELSE 'inventada' END FROM t
""")
def tagger_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of a tagger beside the patterns' ones: one that adds a mention, one inside another mention, one with nothing to look up, one in the header."""
    n = 10 + F.col("p_partkey") % 90
    lead = F.concat(F.lit("Consta do REsp "), n, F.lit(" e da Súmula "))
    keys = table(spark, sf_dir, "part").select("p_partkey").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    rows = keys.select(F.col("p_partkey").alias("doc_id"), F.concat(lead, n, F.lit(" do STJ, no processo administrativo 77 da casa.")).alias("text"), F.length(lead).alias("at"))
    tagged = [(F.lit(9), F.lit(18), "JUR"), (F.col("at"), F.col("at") + 9, "JUR"), (F.col("at") + 14, F.col("at") + 40, "JUR"), (F.col("at") + 14, F.col("at") + 40, "LEI")]
    spans = rows.select("doc_id", F.inline(F.array(*(F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"), F.lit(label).alias("label")) for a, b, label in tagged))))
    even = keys.where("p_partkey % 2 = 0 AND p_partkey < 90").selectExpr("concat('9', p_partkey) AS id", "'sumula' AS nature", "'STJ' AS court", "concat('S', 10 + p_partkey % 90) AS number")
    holdings = even.selectExpr("id", "nature", "court", "number", "CAST(NULL AS string) AS case_class", "CAST(array() AS array<string>) AS appeal_chain", "CAST(NULL AS string) AS state", "CAST(NULL AS string) AS law_key", "CAST(NULL AS string) AS article")
    found = verify(rows.select("doc_id", "text"), holdings, tagger=spans)
    return found.select("doc_id", "start", "end", "form", F.col("fields.source").alias("source"), "verdict")
