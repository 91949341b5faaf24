"""Generated documents: their noise, their truth, and whether verification agrees with it. SQL draws the same by md5."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.operators import training
from citeflow.operators.noise import LOOKALIKES, MARKS, noised
from citeflow.operators.overlap import match_one_to_one
from citeflow.operators.synthetic import KINDS, assembled, citations, paragraphs
from citeflow.plans.catalog import query, table
from citeflow.plans.verify import verify
from citeflow.schema import REGISTRY

SEED = 5


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of the given tables: rulings of orders, some with shared numbers, precedents of parts and nations, articles of suppliers."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    labour, shared = k % 7 == 3, k % 9 == 0
    number = F.concat(F.when(shared, 2_000_000 + F.floor(k / 27)).otherwise(1_000_000_000 + k).cast("string"), F.when(labour, "7820155240091").otherwise(""))

    def one(options: list[str | None], at: Column) -> Column:
        return F.get(F.array(*(F.lit(x).cast("string") for x in options)), (at % len(options)).cast("int"))

    none, nothing = F.array().cast("array<string>"), F.lit(None).cast("string")
    case_class = F.when(labour, one(["RR", "AIRR"], c)).when(shared, "REsp").otherwise(one(["REsp", "HC", "RMS", "AREsp"], c))
    number = F.when(labour, F.substring(number, -20, 20)).otherwise(number)
    rulings = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("1"), k).alias("id"), F.lit("acordao").alias("nature"), F.when(labour, "TST").otherwise("STJ").alias("court"), number.alias("number"), case_class.alias("case_class"),
        F.when((k % 5 == 0) & ~labour, F.array(F.lit("AgRg"))).otherwise(none).alias("appeal_chain"), F.when(~labour, one(["PR", "SP", None], c)).alias("state"),
        F.lit(2020).alias("year"), nothing.alias("relator"), nothing.alias("law_key"), nothing.alias("article"),
    )

    def other(rows: DataFrame, key: Column, digit: str, nature: str, court: Column, number: Column, law: Column, article: Column) -> DataFrame:
        return rows.select(F.concat(F.lit(digit), key).alias("id"), F.lit(nature).alias("nature"), court.alias("court"), number.alias("number"), nothing.alias("case_class"), none.alias("appeal_chain"), nothing.alias("state"), F.lit(None).cast("int").alias("year"), nothing.alias("relator"), law.alias("law_key"), article.alias("article"))

    n, s = F.col("n_nationkey"), F.col("s_suppkey")
    parts = table(spark, sf_dir, "part").where("p_partkey < 100")
    holdings = other(parts, F.col("p_partkey"), "2", "sumula", F.lit("STJ"), F.concat(F.lit("S"), F.col("p_partkey")), nothing, nothing)
    binding = other(table(spark, sf_dir, "nation"), n, "3", "sumula", F.lit("STF"), F.concat(F.lit("SV"), n + 1), nothing, nothing)
    articles = other(table(spark, sf_dir, "supplier"), s, "4", "dispositivo", nothing, nothing, one(["LEI-9504-1997", "CF-1988", "LEI-13105-2015"], s), (s % 900 + 1).cast("string"))
    return rulings.unionByName(holdings).unionByName(binding).unionByName(articles).select(*(f.name for f in spark.createDataFrame([], REGISTRY).schema))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt out before places are drawn for them: the table may be one split
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pair")).repartition(spark.sparkContext.defaultParallelism, "pair")


def _drawn(modulus: int, *keys: object) -> str:
    return f"(CAST(('0x' || substr(md5(concat_ws(':', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})), 1, 8)) AS BIGINT) % {modulus})"


def _kinds() -> str:
    cases, total = [], 0
    for kind, weight in KINDS.items():
        total += weight
        cases.append(f"WHEN drawn < {total} THEN '{kind}'")
    return f"""
planned AS (
  SELECT pair, place, {_drawn(sum(KINDS.values()), 'pair', 'place', SEED, 1)} AS drawn, place < 3 OR {_drawn(3, 'pair', 'place', SEED, 2)} > 0 AS cites
  FROM (SELECT pair, unnest(range(5 + {_drawn(5, 'pair', SEED)})) AS place FROM (SELECT c_custkey AS pair FROM customer))
), kinds AS (
  SELECT pair, place, CASE {' '.join(cases)} END AS kind FROM planned WHERE cites
)"""


@query(f"WITH {_kinds()} SELECT kind, count(*) AS n FROM kinds GROUP BY kind")
def synthetic_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each kind is made; every one that is drawn can be made."""
    return citations(registry(spark, sf_dir), _pairs(spark, sf_dir), SEED).where("kind IS NOT NULL").groupBy("kind").agg(F.count("*").alias("n"))


def judged(docs: DataFrame, gold: DataFrame, rows: DataFrame) -> DataFrame:
    """``gold`` labels of both twins with ``right`` (verdict and record are the truth's) and what verification says of the matched mention."""
    found = verify(docs, rows).select("doc_id", "start", "end", F.col("verdict").alias("found_verdict"), F.col("canonical_id").alias("found_id")).withColumn("id", F.concat_ws(":", "doc_id", "start", "end"))
    labels = gold.withColumn("id", F.concat_ws(":", "doc_id", "place"))
    matched = match_one_to_one(labels.select("doc_id", "id", "start", "end"), found.select("doc_id", "id", "start", "end")).select("gold_id", F.col("found_id").alias("__id"))
    said = found.select(F.col("id").alias("__id"), "found_verdict", F.col("found_id").alias("found_canonical_id"))
    both = labels.join(matched, F.col("id") == F.col("gold_id"), "left").join(said, "__id", "left")
    right = F.col("verdict").eqNullSafe(F.col("found_verdict")) & F.col("canonical_id").eqNullSafe(F.col("found_canonical_id"))
    return both.select("pair", "place", "noisy", "kind", "snippet", "verdict", "canonical_id", "found_verdict", "found_canonical_id", right.alias("right"))


def twins(rows: DataFrame) -> DataFrame:
    """pair, place, kind, clean_right, noisy_right, agree, changed: both decisions of each planned place."""
    side = lambda noisy, name: F.max(F.when(F.col("noisy") == noisy, F.struct("found_verdict", "found_canonical_id", "right", "snippet"))).alias(name)
    both = rows.groupBy("pair", "place", "kind").agg(side(False, "clean"), side(True, "noised"))
    agree = F.col("clean.found_verdict").eqNullSafe(F.col("noised.found_verdict")) & F.col("clean.found_canonical_id").eqNullSafe(F.col("noised.found_canonical_id"))
    return both.select("pair", "place", "kind", F.col("clean.right").alias("clean_right"), F.col("noised.right").alias("noisy_right"), agree.alias("agree"), (F.col("clean.snippet") != F.col("noised.snippet")).alias("changed"))


@query(f"WITH {_kinds()} SELECT kind, count(*) AS n, CAST(0 AS BIGINT) AS clean_wrong, true AS noise_is_withstood, true AS noise_changes_texts FROM kinds GROUP BY kind")
def noise_twins_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a registry, verified clean and noisy: no clean citation against the truth, nine in ten twins alike, a fifth of the noisy ones of each kind really changed at least."""
    rows = registry(spark, sf_dir)
    # documents and labels are read from the same paragraphs: else citations, their truth and their noise are all made twice
    docs, gold = assembled(paragraphs(citations(rows, _pairs(spark, sf_dir), SEED), SEED).persist(StorageLevel.DISK_ONLY))
    both = twins(judged(docs, gold, rows))
    share = lambda c: F.avg(F.col(c).cast("double"))
    return both.groupBy("kind").agg(
        F.count("*").alias("n"), F.count_if(~F.col("clean_right")).alias("clean_wrong"), (share("agree") >= 0.9).alias("noise_is_withstood"), (share("changed") >= 0.2).alias("noise_changes_texts")
    )


def _noise_sql() -> str:
    """Two steps over all kinds of noise: the first in the drawn order that can change the text, then the next one after it."""
    like = " ".join(f"WHEN '{d}' THEN '{letters}'" for d, letters in LOOKALIKES.items())
    marks = "[" + ", ".join(f"'{m}'" for m in MARKS) + "]"
    letter = "[A-Za-zÀ-ÿ]"
    chars = "string_split(t, '')"
    at = {
        0: f"[i for i in range(length(t)) if c[i + 1] IN ({', '.join(map(repr, LOOKALIKES))}) AND (regexp_matches(coalesce(CASE WHEN i > 0 THEN c[i] END, ''), '[0-9./-]') OR regexp_matches(coalesce(c[i + 2], ''), '[0-9./-]'))]",
        1: "[i for i in range(2, length(t)) if regexp_full_match(substr(t, i - 1, 3), '[0-9][-.][0-9]')]",
        3: f"[i for i in range(length(t)) if substr(t, i + 1, 2) IN ('nº', 'n°', 'n.') AND NOT regexp_matches(coalesce(CASE WHEN i > 0 THEN c[i] END, ''), '{letter}')][1:1]",
        4: "[i for i in range(1, length(t)) if regexp_full_match(substr(t, i, 3), '[0-9]-[0-9]| - ')][1:1]",
        5: "[i for i in range(length(t)) if lower(substr(t, i + 1, 6)) = 'súmula'][1:1]",
        6: f"[i for i in range(length(t)) if c[i + 1] IN ('m', 'M') AND (regexp_matches(coalesce(CASE WHEN i > 0 THEN c[i] END, ''), '{letter}') OR regexp_matches(coalesce(c[i + 2], ''), '{letter}'))]",
        7: f"[i for i in range(length(t)) if lower(substr(t, i + 1, 2)) = 'rn' AND (regexp_matches(coalesce(CASE WHEN i > 0 THEN c[i] END, ''), '{letter}') OR regexp_matches(coalesce(c[i + 3], ''), '{letter}'))]",
    }
    at[2] = at[1]
    cut = {0: 1, 1: 0, 2: 0, 3: 2, 4: 1, 5: 1, 6: 1, 7: 2}
    put = {
        0: f"substr(CASE substr(t, i + 1, 1) {like} END, CAST(d % 2 + 1 AS INTEGER), 1)", 1: "' '", 2: "chr(10)", 3: f"{marks}[CAST(d % 4 + 1 AS INTEGER)]", 4: "'–'", 5: "'5'",
        6: "CASE WHEN substr(t, i + 1, 1) = 'M' THEN 'RN' ELSE 'rn' END", 7: "CASE WHEN substr(t, i + 1, 1) = 'R' THEN 'M' ELSE 'm' END",
    }

    def case(of: dict[int, object]) -> str:
        return "CASE k " + " ".join(f"WHEN {k} THEN {of[k]}" for k in range(8)) + " END"

    def step(source: str, out: str) -> str:
        return f"""
{out}_tried AS (
  SELECT s.id, s.t, s.m, s.n, k, d, o, {case(at)} AS places FROM (SELECT *, {chars} AS c FROM {source}) AS s JOIN dealt USING (id) WHERE o > s.last
), {out}_edits AS (
  SELECT *, {case(put)} AS put, {case(cut)} AS cut FROM (SELECT *, places[CAST(d % len(places) + 1 AS INTEGER)] AS i FROM {out}_tried WHERE len(places) > 0)
), {out}_first AS (
  SELECT * FROM {out}_edits WHERE k <> 3 OR put <> substr(t, i + 1, 2) QUALIFY row_number() OVER (PARTITION BY id ORDER BY o, k) = 1
), {out} AS (
  SELECT s.id, coalesce(substr(f.t, 1, i) || put || substr(f.t, i + cut + 1), s.t) AS t, coalesce(f.o, 9999999999) AS last, CAST(s.n + CASE WHEN f.id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n,
         CASE WHEN f.id IS NULL THEN s.m ELSE s.m[1 : i] || [s.m[CAST(greatest(i + least(j, cut), 1) AS INTEGER)] for j in range(1, length(put) + 1)] || s.m[i + cut + 1 :] END AS m
  FROM {source} AS s LEFT JOIN {out}_first AS f ON s.id = f.id
)"""

    return f"""
WITH ids AS (SELECT p_partkey AS id FROM part), s0 AS (
  SELECT id, t, range(length(t)) AS m, CAST(0 AS INTEGER) AS n, CAST(-1 AS BIGINT) AS last FROM (SELECT id, {_CITED_SQL} AS t FROM ids)
), dealt AS (
  SELECT id, k, {_drawn(2**32, 'id', SEED, "'order'", 'k')} AS o, {_drawn(2**31, 'id', SEED, "'draw'", 'k')} AS d FROM ids, range(8) AS r(k)
), {step('s0', 's1')}, {step('s1', 's2')}
SELECT id AS p_partkey, t AS noised, array_to_string(m, ',') AS places, n AS edits FROM s2
"""


_CITED = ["Agravo Interno no REsp nº 1.2NN.567/SP", "Súmula n. NN do STJ", "AgRg no AREsp n° 9NN.519 - RJ", "TST-AIRR-12345NN-78.2015.5.24.0091", "art. NN, § 1º do CPC"]
_CITED_SQL = "replace([" + ", ".join(f"'{c}'" for c in _CITED) + "][CAST(id % 5 + 1 AS INTEGER)], 'NN', CAST(10 + id % 90 AS VARCHAR))"


def noise_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations after up to two edits, with the original place of every character."""
    id_ = F.col("p_partkey")
    text = F.replace(F.get(F.array(*map(F.lit, _CITED)), (id_ % 5).cast("int")), F.lit("NN"), (10 + id_ % 90).cast("string"))
    made = table(spark, sf_dir, "part").select("p_partkey", text.alias("text")).withColumn("n", noised(F.col("text"), "p_partkey", SEED))
    return made.select("p_partkey", F.col("n.text").alias("noised"), F.array_join("n.map", ",").alias("places"), F.col("n.edits").alias("edits"))


query(_noise_sql())(noise_places)


@query("""
WITH d AS (SELECT c_custkey AS k, 'REsp ' || c_custkey AS a, 'HC ' || (c_custkey * 7) AS b, 'Pet ' || (c_custkey * 11) AS c FROM customer), t AS (
  SELECT *, CASE WHEN k % 2 = 0 THEN 'Consta ' || a || ' dos autos, e basta.' ELSE 'Veja ' || a || ' agora.' END AS s1, 'Leia ' || b || ' depois.' AS s2o,
         CASE WHEN k % 3 = 0 THEN b || ' decide.' ELSE 'Leia ' || b || ' depois.' END AS s2, 'Note ' || c || ' enfim.' AS s3 FROM d
)
SELECT k AS c_custkey, s1 || ' ' || s2 || ' ' || s3 AS text, CAST(CASE WHEN k % 2 = 0 THEN 7 ELSE 5 END AS INTEGER) AS first_at,
       CAST(length(s1) + 1 + CASE WHEN k % 3 = 0 THEN 0 ELSE 5 END AS INTEGER) AS second_at, CAST(length(s1) + length(s2) + 2 + 5 AS INTEGER) AS third_at, true AS snippets_hold FROM t
""")
def paraphrase_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spans a document, of which none to two sentences are paraphrased: where all of them are afterwards."""
    k = F.col("c_custkey")
    cited = [F.concat(F.lit("REsp "), k), F.concat(F.lit("HC "), k * 7), F.concat(F.lit("Pet "), k * 11)]
    sentences = [F.concat(F.lit(a), c, F.lit(b)) for (a, b), c in zip((("Veja ", " agora."), ("Leia ", " depois."), ("Note ", " enfim.")), cited, strict=True)]
    docs = table(spark, sf_dir, "customer").select(k.alias("doc_id"), F.concat_ws(" ", *sentences).alias("text"), F.array(*cited).alias("cited"), F.array(*map(F.length, sentences)).alias("sizes"))
    at = [F.lit(0), F.col("sizes")[0] + 1, F.col("sizes")[0] + F.col("sizes")[1] + 2]
    spans = docs.select("doc_id", F.inline(F.array(*(F.struct(F.lit(i).alias("n"), (a + 5).alias("start"), (a + 5 + F.length(F.col("cited")[i])).alias("end")) for i, a in enumerate(at)))))
    said = [(F.col("doc_id") % 2 == 0, 0, "Consta [[X]] dos autos, e basta."), (F.col("doc_id") % 3 == 0, 1, "[[X]] decide."), (F.col("doc_id") % 5 == 0, 2, "sem marca")]
    given = F.filter(F.array(*(F.when(when, F.struct(at[i].alias("sentence_start"), (at[i] + F.col("sizes")[i]).alias("sentence_end"), F.lit(p).alias("paraphrase"))) for when, i, p in said)), lambda x: x.isNotNull())
    new, moved = training.paraphrased_documents(docs.select("doc_id", "text"), spans, docs.select("doc_id", F.inline(given)), "[[X]]")
    placed = moved.groupBy("doc_id").agg(*(F.max(F.when(F.col("n") == i, F.col("start"))).alias(name) for i, name in enumerate(("first_at", "second_at", "third_at"))), F.array_sort(F.collect_list(F.struct("n", "start", "end"))).alias("all"))
    whole = new.join(placed, "doc_id").join(docs.select("doc_id", "cited"), "doc_id")
    holds = F.forall(F.arrays_zip("all", "cited"), lambda x: F.col("text").substr(x["all"]["start"] + 1, x["all"]["end"] - x["all"]["start"]) == x["cited"])
    return whole.select(F.col("doc_id").alias("c_custkey"), "text", "first_at", "second_at", "third_at", holds.alias("snippets_hold"))
