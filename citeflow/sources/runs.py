"""A run's settings, its manifest and its reports."""

from __future__ import annotations

import hashlib
import json
import os
import platform
import tomllib
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from citeflow import dims, schema
from citeflow.operators import evaluate

# What counts as yes in the environment, and names that hold secrets.
YES = {"1", "true", "yes", "sim", "on"}
SECRET = ("TOKEN", "KEY", "SECRET", "PASSWORD")


@dataclass(frozen=True)
class Settings:
    use_tagger: bool = False
    extract_vague: bool = False
    seed: int = 0

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def settings(path: str | None = None, environment: Mapping[str, str] = os.environ, prefix: str = "CITEFLOW_") -> Settings:
    """Defaults, then a TOML file's values, then the environment's."""
    out = Settings()
    if path:
        with open(path, "rb") as file:
            given = tomllib.load(file)
        out = replace(out, **{f.name: given[f.name] for f in fields(Settings) if f.name in given})
    for f in fields(Settings):
        raw = environment.get(prefix + f.name.upper())
        if raw is not None:
            out = replace(out, **{f.name: raw.strip().lower() in YES if isinstance(f.default, bool) else int(raw)})
    return out


def redacted(environment: Mapping[str, str]) -> dict[str, str]:
    return {k: "***" if any(s in k.upper() for s in SECRET) else v for k, v in environment.items()}


def content_sums(rows: DataFrame) -> DataFrame:
    """One row, n, first, second: the count and order-free digests of a table's rows, equal for two runs that give the same rows."""
    line = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    halves = [F.conv(F.substring(line, k, 12), 16, 10).cast("decimal(20,0)") for k in (1, 13)]
    return rows.select(*(h.alias(f"h{k}") for k, h in enumerate(halves))).agg(F.count("*").alias("n"), F.sum("h0").alias("first"), F.sum("h1").alias("second"))


def content_digest(rows: DataFrame) -> Row:
    return content_sums(rows).first()


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, bytes, sha256 of every file under ``path``; files are hashed where they are read, one at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def inputs_digest(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, dict]:
    """For each named input its files, bytes and one digest of all of them that no order changes."""
    out = {}
    for name, path in sorted(paths.items()):
        files = file_digests(spark, path)
        found = content_digest(files.select("bytes", "sha256"))
        total = files.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        out[name] = {"files": found["n"], "bytes": total, "digest": f"{found['first']}-{found['second']}"}
    return out


def tables_digest() -> str:
    """Of all lookup tables and closed domains."""
    held = {f"{module.__name__}.{name}": value for module in (dims, schema) for name, value in vars(module).items() if name.isupper() and isinstance(value, (dict, list, int, float, str))}
    return hashlib.sha256(json.dumps(held, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def same_content(a: DataFrame, b: DataFrame) -> bool:
    return content_digest(a) == content_digest(b)


def manifest(verified: DataFrame, used: Settings, timings: Mapping[str, float] | None = None, inputs: Mapping[str, str] | None = None, environment: Mapping[str, str] | None = None) -> dict:
    """Counts by path and class, digests of settings, lookup tables and ``inputs`` (paths by name), versions, the environment without secrets.

    A few rows come to the driver, one for each path and input.
    """
    counts = verified.groupBy("path", "verdict").agg(F.count("*").alias("n")).collect()
    by_class: dict[str, int] = {}
    for r in counts:
        by_class[r["verdict"]] = by_class.get(r["verdict"], 0) + r["n"]
    return {
        "settings": asdict(used) | {"sha256": used.digest()},
        "versions": {"python": platform.python_version(), "spark": verified.sparkSession.version},
        "paths": {r["path"]: r["n"] for r in sorted(counts)},
        "classes": dict(sorted(by_class.items())),
        "timings": dict(timings or {}),
        "tables": tables_digest(),
        "inputs": inputs_digest(verified.sparkSession, inputs or {}),
        "environment": redacted(dict(sorted((environment or {}).items()))),
    }


def report_data(pairs: DataFrame, errors: int = 40) -> dict:
    """Scores by tier, the confusion matrix, and at most ``errors`` examples of each kind of error, with path and snippet where ``pairs`` has them."""
    shown = [c for c in ("doc_id", "gold_class", "found_class", "path", "snippet") if c in pairs.columns]
    return {
        "tiers": [r.asDict() for r in evaluate.tier_scores(pairs).orderBy("tier").collect()],
        "confusion": [r.asDict() for r in evaluate.confusion(pairs).orderBy("gold_class", "found_class").collect()],
        "errors": [{c: r[c] for c in shown} for r in evaluate.first_errors(pairs, errors).orderBy("gold_class", "found_class", "k").collect()],
    }


def report(pairs: DataFrame, errors: int = 40, as_json: bool = False) -> str:
    """``report_data`` as Markdown or JSON."""
    data = report_data(pairs, errors)
    if as_json:
        return json.dumps(data, ensure_ascii=False, sort_keys=True, indent=1)
    lines = ["# Scores", "", "| tier | macro F1 | tau | Brier | score |", "|---|---|---|---|---|"]
    for r in data["tiers"]:
        lines.append(f"| {r['tier']} | {r['macro_f1']:.5f} | {r['tau']:.5f} | {'-' if r['brier'] is None else format(r['brier'], '.5f')} | {r['score']:.5f} |")
    lines += ["", "# Confusion", "", "| gold | found | n |", "|---|---|---|"]
    lines += [f"| {r['gold_class']} | {r['found_class']} | {r['n']} |" for r in data["confusion"]]
    lines += ["", "# Errors", ""]
    for r in data["errors"]:
        more = "".join(f", {r[c]}" for c in ("path", "snippet") if r.get(c))
        lines.append(f"- {r['gold_class']} as {r['found_class']}: {r['doc_id']}{more}")
    return "\n".join(lines) + "\n"
