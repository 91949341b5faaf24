"""Repeated passages by sliding sentence spans and word runs.

Sentences end at ``.``, ``!`` or ``?`` before white space, and at line ends; one of fewer than ``LEAST_WORDS`` words
counts with the next (shouted text has a mark at every word). From every sentence a span runs over the following ones
until it holds ``SENTENCES`` of them and ``SPAN_WORDS`` words. A passage that begins or ends inside a sentence, or has none,
has no such span, so every run of ``ENOUGH_WORDS`` words is a span too; where spans of sentences would be at least as
long, the runs cover them and are the only spans.

Few spans repeat, so they are found in two steps. The seed of a run is the least hash of the ``SEED_WORDS``-word runs in
it: equal runs have equal seeds, and neighbours mostly share theirs. A span of sentences has 32 bits of its hash for a
seed. The first step counts every text's distinct seeds; the second hashes the spans whose seed occurs more than once, in
the texts that hold one. No repeated span is lost.

Spans are hashed and joined over all documents; the first holder of a span is the smallest doc_id, at its first place
there. Text goes when a repeated span that is not the first covers it. Seeds and spans are counted with map-side sums,
and meet their counts in joins that Spark can split: no passage's holders are ever gathered. What goes is exactly what
whole spans cover, of sentences or of words, that an earlier place holds.

Defined results: case (A-Z) and ASCII white space do not count; texts too short for a span, null and empty texts repeat
nothing; texts of any length are read whole; rows with a null doc_id neither lose nor hold anything; rows that share a
doc_id (repeated rows too) are one holder, and lose nothing to each other but what one of them repeats within itself;
of equal holders the smaller doc_id, then the earlier place is first; an empty table gives no rows; further columns
are kept when rows are returned and ignored otherwise, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.llm.common import cut, shared_path, slices, texts, unused

SENTENCES = 3
LEAST_WORDS = 4
SPAN_WORDS = 12
ENOUGH_WORDS = 50
SEED_WORDS = 20
#: Repeated runs are taken at every word, so no words stay at a passage's edges.
WINDOW = 1
#: Longer texts are hashed in pieces of about this many bytes, cut at white space.
PIECE_BYTES = 1 << 22

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint64)
_BYTE_BASE, _WORD_BASE = 0x100000001B3, 0x9E3779B97F4A7C15
_SEEDS = "hash bigint, doc_id bigint, n int"
#: ``place`` holds start (31 bits), length (31 bits) and mark (2 bits: 1 for the first of its hash in its text, and 2 for
#: a run of ``ENOUGH_WORDS`` words): as columns of their own they took a third more disk.
_SPANS = "hash bigint, doc_id bigint, place bigint"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _computed_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@functools.lru_cache(4)
def _held_powers(base: int, n: int) -> np.ndarray:
    return _computed_powers(base, n)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64; tables for the usual sizes are kept."""
    return _held_powers(base, 1 << 18)[:n] if n <= 1 << 18 else _computed_powers(base, n)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    return np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values * _powers(base, len(values)))))


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        end = at + PIECE_BYTES
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield at, min(end, len(data))
        at = end


class Words:
    """Places (in bytes) of the words of a text, and hashes of any run of them."""

    def __init__(self, text: bytes):
        self.data = data = np.frombuffer(text, dtype=np.uint8)
        starts, ends, hashes = [], [], []
        for a, b in _pieces(data):
            piece = data[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[piece], [True])).view(np.int8)))
            s, e = edges[::2], edges[1::2]
            sums = _sums(_LOWER[piece] + np.uint64(1), _BYTE_BASE)
            hashes.append(_mixed((sums[e] - sums[s]) * _powers(_inverse(_BYTE_BASE), len(piece))[s]))
            starts.append(s + a)
            ends.append(e + a)
        none = np.empty(0, dtype=np.int64)
        self.starts, self.ends = np.concatenate([none, *starts]), np.concatenate([none, *ends])
        self.sums = _sums(np.concatenate([none.astype(np.uint64), *hashes]), _WORD_BASE)
        self._back = _powers(_inverse(_WORD_BASE), len(self.starts))

    def hashes(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the runs of words ``first`` to ``end`` (exclusive): equal for equal words."""
        return _mixed((self.sums[end] - self.sums[first]) * self._back[first] + (end - first).astype(np.uint64)).view(np.int64)

    def sentence_ends(self) -> np.ndarray:
        """The word after each sentence; short sentences count with the next one, a last short one with the one before."""
        last = self.data[self.ends - 1]
        closed = (last == 0x2E) | (last == 0x21) | (last == 0x3F)
        lines = np.concatenate(([0], np.cumsum((self.data == 0x0A) | (self.data == 0x0D))))
        closed[:-1] |= lines[self.starts[1:]] > lines[self.ends[:-1]]
        closed[-1:] = True
        out, at = [], 0
        for end in (np.flatnonzero(closed) + 1).tolist():
            if end - at >= LEAST_WORDS:
                out.append(end)
                at = end
        if at < len(closed):
            out[-1:] = [len(closed)]
        return np.array(out, dtype=np.int64)

    def sentence_spans(self, sentences: int, span_words: int) -> tuple[np.ndarray, np.ndarray]:
        ends = self.sentence_ends()
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        upto = np.maximum(np.searchsorted(ends, starts + span_words), np.arange(len(starts)) + sentences - 1)
        whole = upto < len(ends)
        return starts[whole], ends[upto[whole]]

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The seed of every run of ``ENOUGH_WORDS`` words, and the seeds at all places that have one."""
        if len(self.starts) < ENOUGH_WORDS:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        at, width = np.arange(len(self.starts) - SEED_WORDS + 1), ENOUGH_WORDS - SEED_WORDS + 1
        hashes = self.hashes(at, at + SEED_WORDS)
        least = _sliding(np.minimum, hashes, width)
        edge = np.full(width - 1, np.iinfo(np.int64).min)
        return least, hashes[_sliding(np.maximum, np.concatenate((edge, least, edge)), width) == hashes]


def _sliding(take: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``take`` over every ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = take(x[:-step], x[step:])
        done += step
    return x


def _cut_into_words(text: bytes, least: int) -> Words | None:
    """None where a text is too short for ``least`` words."""
    words = Words(text) if len(text) >= 2 * least - 1 else None
    return words if words and len(words.starts) >= least else None


def _short(hashes: np.ndarray) -> np.ndarray:
    """The seeds of spans of sentences, of these hashes."""
    return hashes & 0xFFFFFFFF


def spans(text: bytes, sentences: int = SENTENCES, span_words: int = SPAN_WORDS, repeated: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (code points) of every span of a text, or of those with a seed in ``repeated``."""
    return marked_spans(text, sentences, span_words, repeated)[:3]


def marked_spans(text: bytes, sentences: int, span_words: int, repeated: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``spans`` with their marks."""
    words = _cut_into_words(text, min(span_words, ENOUGH_WORDS))
    if words is None:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int8)
    if repeated is None:
        first = np.arange(max(0, len(words.starts) - ENOUGH_WORDS + 1))
    else:
        first = np.flatnonzero(np.isin(words.seeds()[0], repeated)) if len(repeated) else np.empty(0, dtype=np.int64)
    end = first + ENOUGH_WORDS
    if span_words < ENOUGH_WORDS:
        some = words.sentence_spans(sentences, span_words)
        if repeated is not None:
            held = np.isin(_short(words.hashes(*some)), repeated)
            some = some[0][held], some[1][held]
        own = [np.concatenate(x) for x in zip(some, (first, end), strict=True)]
        both = np.unique((own[0] << 32) | own[1])
        first, end = both >> 32, both & 0xFFFFFFFF
    start, stop = words.starts[first], words.ends[end - 1]
    if not text.isascii():
        points = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
        start, stop = points[start], points[stop]
    hashes, mark = words.hashes(first, end), 2 * (end - first == ENOUGH_WORDS).astype(np.int8)
    mark[np.unique(hashes, return_index=True)[1]] += 1
    return hashes, start.astype(np.int32), stop.astype(np.int32), mark


def _columns(columns: list[list], kinds: list, names: list[str]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k)) for c, k in zip(columns, kinds, strict=True)], names=names)


def _emit_seeds(batches: Iterator, sentences: int, span_words: int) -> Iterator:
    """The distinct seeds of each text, and how many of its places have them."""
    by_sentences = span_words < ENOUGH_WORDS
    kinds = [np.int64, np.int64, np.int32]
    for batch in slices(batches, 256):
        columns: list[list] = [[np.empty(0, dtype=k)] for k in kinds]
        for number, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
            words = _cut_into_words(text, min(span_words, ENOUGH_WORDS))
            if words is not None:
                own = [words.seeds()[1], *([_short(words.hashes(*words.sentence_spans(sentences, span_words)))] if by_sentences else [])]
                seeds, n = np.unique(np.concatenate(own), return_counts=True)
                for c, v in zip(columns, (seeds, np.full(len(seeds), number), n), strict=True):
                    c.append(v)
        yield _columns(columns, kinds, ["hash", "doc_id", "n"])


def _emit(batches: Iterator, sentences: int, span_words: int) -> Iterator:
    kinds = [np.int64, np.int64, np.int64]
    for batch in slices(batches, 256):
        columns: list[list] = [[np.empty(0, dtype=k)] for k in kinds]
        seeds = batch.column("seeds")
        for k, (number, text) in enumerate(zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True)):
            repeated = seeds[k].values.to_numpy(zero_copy_only=False) if seeds[k].is_valid else np.empty(0, dtype=np.int64)
            h, a, b, mark = marked_spans(text, sentences, span_words, repeated)
            place = (a.astype(np.int64) << 33) | ((b - a).astype(np.int64) << 2) | mark
            for c, v in zip(columns, (h, np.full(len(h), number), place), strict=True):
                c.append(v)
        yield _columns(columns, kinds, ["hash", "doc_id", "place"])


def _stretched(docs: DataFrame, doc_id: str, text: str, sentences: int, span_words: int) -> DataFrame:
    """doc_id, start, end, first_doc_id of every span that goes, with the number of its ``stretch`` in the text; for runs also that of their ``part``, of runs alone."""
    spark = docs.sparkSession
    seeds_path, path = shared_path(spark, "span-seeds"), shared_path(spark, "sentence-spans")
    known = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    known.mapInArrow(functools.partial(_emit_seeds, sentences=sentences, span_words=span_words), _SEEDS).write.option("compression", "zstd").parquet(seeds_path)
    seeds = spark.read.schema(_SEEDS).parquet(seeds_path)
    several = seeds.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash")
    marks = seeds.select("hash", "doc_id").join(several, "hash").groupBy("doc_id").agg(F.collect_set("hash").alias("seeds"))
    known.join(marks, "doc_id").mapInArrow(functools.partial(_emit, sentences=sentences, span_words=span_words), _SPANS).write.option("compression", "zstd").parquet(path)
    every = spark.read.schema(_SPANS).parquet(path)
    repeated = cut(every.groupBy("hash").agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = every.join(repeated, "hash").where("NOT (doc_id = first_doc_id AND place & 1 = 1)").drop("hash").repartition("doc_id")
    start = F.shiftrightunsigned("place", 33).cast("int")
    later = later.select("doc_id", "first_doc_id", start.alias("start"), (start + F.shiftright("place", 2).bitwiseAND(0x7FFFFFFF)).cast("int").alias("end"), (F.col("place").bitwiseAND(2) > 0).alias("is_run"))
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    is_run = F.col("is_run")
    ended = {"stretch": F.max("end"), "part": F.max(F.when(is_run, F.col("end")))}
    found = later.withColumns({name: end.over(order.rowsBetween(Window.unboundedPreceding, -1)) for name, end in ended.items()})
    begins = {"stretch": F.lit(True), "part": is_run}
    begins = {name: F.sum(F.when(when & ~F.coalesce(F.col(name) >= F.col("start"), F.lit(False)), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)) for name, when in begins.items()}
    return found.withColumns(begins).withColumn("part", F.when(is_run, F.col("part"))).drop("is_run")


def _stretch() -> list[Column]:
    return [F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_spans"), F.min("first_doc_id").alias("first_doc_id")]


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences: int = SENTENCES, span_words: int = SPAN_WORDS) -> DataFrame:
    """doc_id, start, end, n_spans, first_doc_id for every stretch of text that goes; first_doc_id holds (some of) it first.

    A span has ``sentences`` sentences and ``span_words`` words at least; more words spare short passages that texts share.
    """
    return _stretched(docs, doc_id, text, sentences, span_words).groupBy("doc_id", "stretch").agg(*_stretch()).drop("stretch")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences: int = SENTENCES, span_words: int = SPAN_WORDS) -> DataFrame:
    """The stretches of ``repeated_spans`` as passage_start, passage_end and passage_first_doc_id, and what runs of words cover of them.

    doc_id, start, end, n_spans, first_doc_id are one such part: repeated runs of ``ENOUGH_WORDS`` words that touch or
    overlap. A passage with several has a row for each; one that only spans of sentences cover has one row with an empty
    part, where it begins.
    """
    parts = _stretched(docs, doc_id, text, sentences, span_words).groupBy("doc_id", "stretch", "part").agg(*_stretch())
    whole = Window.partitionBy("doc_id", "stretch")
    over = {"passage_start": F.min("start"), "passage_end": F.max("end"), "passage_first_doc_id": F.min("first_doc_id"), "parts": F.count("part")}
    rows = parts.withColumns({name: f.over(whole) for name, f in over.items()}).where("part IS NOT NULL OR parts = 0")
    empty = F.col("part").isNull()
    rows = rows.withColumns({"end": F.when(empty, F.col("start")).otherwise(F.col("end")), "n_spans": F.when(empty, 0).otherwise(F.col("n_spans"))})
    return rows.drop("stretch", "part", "parts")


def _without(keep: list[str], text: str) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            out = []
            for x, gone in zip(batch.column(text).to_pylist(), batch.column(len(keep)).to_pylist(), strict=True):
                for a, b in sorted(((g["start"], g["end"]) for g in gone or ()), reverse=True):
                    x = x[:a].rstrip() + ("\n" if a and b < len(x) else "") + x[b:].lstrip()
                out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out, batch.schema.field(c).type) if c == text else batch.column(c) for c in keep], names=keep)

    return run


def drop_repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences: int = SENTENCES, span_words: int = SPAN_WORDS) -> DataFrame:
    """``docs`` with the repeated stretches cut out of their texts."""
    free = unused(docs.columns, "gone", "holder")
    gone = repeated_spans(docs, doc_id, text, sentences, span_words).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias(free["gone"]))
    gone = gone.withColumnRenamed("doc_id", free["holder"])
    joined = docs.join(gone, docs[doc_id].cast("long") == gone[free["holder"]], "left").drop(free["holder"])
    return joined.mapInArrow(_without(docs.columns, text), docs.schema)
