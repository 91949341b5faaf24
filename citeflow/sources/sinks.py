"""Writers: submissions, per-document JSON, traces, and the output contract."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.functions.intervals import half_covered, touching
from citeflow.schema import VERDICT_CLASSES


def cells(documents: DataFrame, verified: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, cells: a document's mentions as ``start,end,class,id,confidence`` by position; ``-`` where there is none."""
    text = F.concat_ws(",", "start", "end", "verdict", F.coalesce("canonical_id", F.lit("-")), F.when(F.col("confidence").isNotNull(), F.format_string("%.4f", "confidence")).otherwise("-"))
    item = F.struct("start", "end", text.alias("cell"))
    grouped = verified.groupBy(doc).agg(F.array_sort(F.collect_list(item)).alias("items"))
    joined = documents.select(doc).distinct().join(grouped, doc, "left")
    return joined.select(doc, F.coalesce(F.array_join(F.transform("items", lambda x: x["cell"]), "|"), F.lit("-")).alias("cells"))


def write_submission(documents: DataFrame, verified: DataFrame, path: str, doc: str = "doc_id") -> None:
    cells(documents, verified, doc).orderBy(doc).write.csv(path, header=True, lineSep="\r\n", escape='"', mode="overwrite")


def document_json(verified: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, json: absent confidences and targets are left out."""
    target = F.when(F.col("verdict") == "real", F.struct(F.col("canonical_id"))).otherwise(F.struct(F.lit(None).cast("string").alias("canonical_id")))
    item = F.struct("start", "end", "snippet", "type", "verdict", target.alias("resolution"), "confidence")
    grouped = verified.groupBy(doc).agg(F.array_sort(F.collect_list(item)).alias("citations"))
    return grouped.select(doc, F.to_json(F.struct(F.col(doc), "citations")).alias("json"))


def write_trace(verified: DataFrame, path: str, doc: str = "doc_id") -> None:
    verified.orderBy(doc, "start", "end").select(F.to_json(F.struct(*sorted(verified.columns))).alias("value")).write.mode("overwrite").text(path)


def violations(verified: DataFrame, documents: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Mentions (with doc, start, end) that break the output contract, and which rule: one row for each breach."""
    with_text = verified.join(documents.select(doc, "text"), doc, "left")

    def rule(name: str, broken: Column) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), name)

    real = F.col("verdict") == "real"
    rules = [
        rule("bounds", F.col("text").isNull() | (F.col("start") < 0) | (F.col("end") <= F.col("start")) | (F.col("end") > F.length("text"))),
        rule("snippet", F.col("snippet") != F.col("text").substr(F.col("start") + 1, F.col("end") - F.col("start"))),
        rule("class", ~F.col("verdict").isin(VERDICT_CLASSES)),
        rule("target", (real & ~F.coalesce(F.col("canonical_id").rlike("^[0-9]+$"), F.lit(False))) | (~real & F.col("canonical_id").isNotNull())),
        rule("type", (F.col("type") == "lei") != (F.col("form") == "lei_artigo")),
        rule("confidence", ~F.col("confidence").between(0, 1)),
    ]
    single = with_text.select(doc, "start", "end", F.explode(F.array_compact(F.array(*rules))).alias("rule"))
    other = verified.select(doc, F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    later = (F.col("o_start") > F.col("start")) | ((F.col("o_start") == F.col("start")) & (F.col("o_end") > F.col("end")))
    met = touching(verified.select(doc, "start", "end"), other, [doc], "start", "end", "o_start", "o_end")
    pairs = met.where(later & half_covered(F.col("start"), F.col("end"), F.col("o_start"), F.col("o_end")))
    return single.unionByName(pairs.select(doc, "start", "end", F.lit("overlap").alias("rule")))


def write_documents(verified: DataFrame, documents: DataFrame, path: str, doc: str = "doc_id") -> None:
    """One JSON text for each document, a line each; nothing is written if a mention breaks the contract.

    ``unpack_documents`` makes folders of those that are wanted one by one.
    """
    broken = violations(verified, documents, doc)
    if found := broken.groupBy("rule").count().collect():
        raise ValueError("output breaks the contract: " + ", ".join(f"{r['rule']} {r['count']}" for r in sorted(found)))
    document_json(verified, doc).select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def unpack_documents(spark: SparkSession, path: str, out: str, ids: DataFrame, doc: str = "doc_id") -> None:
    """The documents of ``ids`` from ``path`` of ``write_documents``, each in a folder of its own."""
    lines = spark.read.text(path).select(F.get_json_object("value", f"$.{doc}").alias(doc), "value")
    lines.join(ids.select(F.col(doc).cast("string").alias(doc)).distinct(), doc, "left_semi").write.partitionBy(doc).mode("overwrite").text(out)


def write_examples(examples: DataFrame, path: str) -> dict:
    """Training examples as JSON lines, beside a manifest with their count and an order-free digest, which is returned."""
    from citeflow.sources.runs import content_digest

    examples.write.mode("overwrite").json(f"{path}/examples")
    found = content_digest(examples)
    made = {"examples": found["n"], "digest": f"{found['first']}-{found['second']}"}
    _write_text(examples.sparkSession, f"{path}/manifest", json.dumps(made, sort_keys=True))
    return made


def write_synthetic(documents: DataFrame, gold: DataFrame, pairs: DataFrame, split: DataFrame, path: str, seed: int) -> None:
    """A synthetic set: texts (JSON lines with their ids), gold labels, twins, the split, and the seed that gives it all again."""
    documents.select("doc_id", "text").write.mode("overwrite").json(f"{path}/txt")
    gold.write.mode("overwrite").csv(f"{path}/gold", header=True, escape='"')
    pairs.write.mode("overwrite").json(f"{path}/pairs")
    split.write.mode("overwrite").json(f"{path}/split")
    _write_text(documents.sparkSession, f"{path}/manifest", json.dumps({"seed": seed}))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


POINTER = "CURRENT"


def publish(spark: SparkSession, path: str, writers: Mapping[str, Callable[[str], None]]) -> str:
    """All outputs or none: each writer gets a place in a run folder of its own, and one rename makes the run the current one.

    ``CURRENT`` under ``path`` names the run that readers see; it is replaced by a single atomic rename when everything is
    written, so a run that fails anywhere before leaves readers with the whole run that was current. Returns the run's folder.
    """
    run = f"{path.rstrip('/')}/runs/{uuid.uuid4().hex}"
    try:
        for name, write in writers.items():
            write(f"{run}/{name}")
        _point(spark, path, run.rsplit("/", 1)[1])
    except BaseException:
        _hadoop(spark, run)[0].delete(_hadoop(spark, run)[1], True)
        raise
    return run


def _hadoop(spark: SparkSession, name: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(name)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _point(spark: SparkSession, path: str, run: str) -> None:
    fs, new = _hadoop(spark, f"{path}/.{POINTER}-{run}")
    out = fs.create(new, True)
    out.write(bytearray(run.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(context.makeQualified(new), context.makeQualified(_hadoop(spark, f"{path}/{POINTER}")[1]), options)


def published(spark: SparkSession, path: str, name: str) -> str:
    """Where the current run's output ``name`` is; nothing published is an error."""
    fs, pointer = _hadoop(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        raise FileNotFoundError(f"nothing is published under {path}")
    stream = fs.open(pointer)
    run = bytes(stream.readAllBytes()).decode()
    stream.close()
    return f"{path.rstrip('/')}/runs/{run}/{name}"
