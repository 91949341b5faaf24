"""Readers for documents, gold labels, submissions, traces, token files and SQLite registries."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from citeflow.operators.training import EXAMPLE

GOLD = "tier int, doc_id string, citation_id string, start int, end int, snippet string, type string, verdict string, canonical_id string"
TRACE = "doc_id string, start int, end int, snippet string, form string, path string, verdict string, canonical_id string, confidence double"


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the file's name without its ending) and text, line ends untouched."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    return files.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "").alias("doc_id"), F.col("value").alias("text"))


def gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold labels from CSV; ``\\n`` written out in snippets becomes a line end."""
    rows = spark.read.csv(path, header=True, schema=GOLD, escape='"', multiLine=True)
    return rows.withColumn("snippet", F.regexp_replace("snippet", r"\\n", "\n"))


def submission(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, end, verdict, canonical_id, confidence of a submission's cells."""
    return parse_cells(spark.read.csv(path, header=True, schema="doc_id string, cells string", escape='"'))


def parse_cells(rows: DataFrame, doc: str = "doc_id", cells: str = "cells") -> DataFrame:
    """One row for each ``start,end,class,id,confidence`` of the cells; ``-`` and nothing hold none."""
    filled = rows.where(F.col(cells).isNotNull() & ~F.col(cells).isin("", "-"))
    parts = filled.select(doc, F.explode(F.split(cells, r"\|")).alias("c")).select(doc, F.split("c", ",").alias("c"))

    def part(k: int, kind: str):
        return F.nullif(F.get("c", F.lit(k)), F.lit("-")).cast(kind)

    return parts.select(doc, part(0, "int").alias("start"), part(1, "int").alias("end"), part(2, "string").alias("verdict"), part(3, "string").alias("canonical_id"), part(4, "double").alias("confidence"))


def trace(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRACE).json(path)


def examples(spark: SparkSession, path: str) -> DataFrame:
    """Training examples of JSON lines."""
    return spark.read.schema(EXAMPLE).json(path)


def tagged_tokens(spark: SparkSession, path: str) -> DataFrame:
    """token and tag of ``token tag`` lines; blank lines are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.regexp_extract("value", r"^(.*) (\S+)$", 1).alias("token"), F.regexp_extract("value", r"^(.*) (\S+)$", 2).alias("tag"))


_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    """Reads a table in ranges of its row ids, read-only; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, schema, options):
        self.schema, self.options = schema, options
        self.conditions: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of a column with values go into the SELECT; what SQLite can't be asked stays with Spark."""
        for f in filters:
            column = f'"{f.attribute[0]}"' if len(getattr(f, "attribute", ())) == 1 else None
            sign = next((s for kind, s in _COMPARED.items() if type(f) is kind), None)
            if column and sign and isinstance(f.value, (int, float, str)):
                self.conditions.append(f"{column} {sign} ?")
                self.values.append(f.value)
            elif column and type(f) is In and all(isinstance(v, (int, float, str)) for v in f.value):
                self.conditions.append(f"{column} IN ({', '.join('?' * len(f.value))})")
                self.values += f.value
            elif column and type(f) is IsNotNull:
                self.conditions.append(f"{column} IS NOT NULL")
            else:
                yield f

    def _open(self):
        import sqlite3

        connection = sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)
        connection.text_factory = lambda raw: raw.decode("utf-8", "replace")
        return connection

    def partitions(self) -> list[InputPartition]:
        with self._open() as connection:
            low, high = connection.execute(f'SELECT min(rowid), max(rowid) FROM "{self.options["table"]}"').fetchone()
        if low is None:
            return [_Range(0, 0)]
        step = max(1, -(-(high + 1 - low) // int(self.options.get("partitions", 8))))
        return [_Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        columns = ", ".join(f'"{f.name}"' for f in self.schema.fields)
        where = " AND ".join(["rowid >= ?", "rowid < ?", *self.conditions])
        with self._open() as connection:
            yield from connection.execute(f'SELECT {columns} FROM "{self.options["table"]}" WHERE {where}', (partition.low, partition.high, *self.values))


class Sqlite(DataSource):
    """``spark.read.format("sqlite_ro").schema(...).option("table", t).load(path)`` for a file all executors can open."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_ro"

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(schema, dict(self.options))


def sqlite(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """The columns of ``schema``, and no others, of a table; comparisons with values are answered by SQLite."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Sqlite)
    return spark.read.format("sqlite_ro").schema(schema).option("table", table).load(path)
