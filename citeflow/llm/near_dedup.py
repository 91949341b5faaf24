"""Near-duplicate documents by HyperMinHash.

A document is the set of its word shingles, each a 64-bit hash. The top nine bits of a hash choose one of 512 buckets;
of the smallest hash in a bucket the register keeps the count of leading zeros (6 bits) and the eight bits after the
first one. Four neighbouring buckets make one of 128 lanes: the first full register of the four, and which it was.
Lanes without a full bucket borrow from full ones in an order fixed for each lane, so short documents agree in a lane
with the probability of their similarity too. Four lanes make a 64-bit band key, 32 bands a document: a pair of
similarity 0.8 shares no band with probability 5e-8.

Documents with one and the same set are one node. In each band group every node is paired with the smallest node of
the group, never with all others; pairs whose collision-corrected estimate falls short by many standard errors go, the
rest are confirmed on the full sets. The components found so are then held against the groups again: where a group
still holds several components, its members meet in blocks, in which registers (or, of short documents, halves of all
hashes) are compared as matrices and only pairs of different components with a high enough estimate come out, to be
confirmed in the same way. So no link between different sets is lost to the star shape, and no group's pairs are rows.

Defined results: an empty table gives no rows; texts of any length are read whole; a document without words has no
shingles, stands alone and is kept; with fewer words than a shingle
the whole sequence is the one shingle; rows of equal text are copies and the smallest doc_id stands for them; rows
that share a doc_id share its component; rows with a null doc_id link to nothing, have a null component and are kept;
further columns are ignored, or kept when rows are returned. Where rows are returned, one stays of those with the same
doc_id and text, and one of those with a null doc_id and the same text (whatever rows with an id hold); of copies that
differ in further columns the smallest row stays, so these columns must have an order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import cut, frugal, shared_path, slices, texts, unused
from citeflow.llm.components import components

BUCKET_BITS = 9
BUCKETS = 1 << BUCKET_BITS
REST_BITS = 64 - BUCKET_BITS
MANTISSA_BITS = 8
LANES = 128
PER_LANE = BUCKETS // LANES
CACHE_WORDS = 100_000
BLOCK_NODES = 512
HOT = 1000
#: Sets up to this size go to the blocks as the upper halves of their hashes.
FEW = 256
#: Chance that two different minima have the same register: the same leading zeros (1/3) and mantissa.
CHANCE = (1 / 3) / (1 << MANTISSA_BITS)
#: An estimate this far below the threshold is more than five standard errors off: sqrt(0.8 * 0.2 / 512) is 0.018.
SLACK = 0.1

_STARTS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(REST_BITS)
_BORROW = np.argsort(np.random.default_rng(20011).random((LANES, LANES)), axis=1).astype(np.int32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, size: int):
        import xxhash

        class Words(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = h = xxhash.xxh3_64_intdigest(word)
                return h

        self.size, self.hash = size, Words().__getitem__

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        n = len(words)
        if not n:
            return np.empty(0, dtype=np.uint64)
        h = np.fromiter(map(self.hash, words), dtype=np.uint64, count=n)
        size = min(self.size, n)
        out = np.full(n - size + 1, size, dtype=np.uint64)
        for k in range(size):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : n - size + 1 + k])
        return np.unique(out)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The 512 registers (uint16, 0 for an empty bucket) of a sorted, non-empty set."""
    at = np.searchsorted(shingles, _STARTS)
    full = np.diff(np.append(at, len(shingles))) > 0
    least = shingles[np.minimum(at, len(shingles) - 1)] & np.uint64((1 << REST_BITS) - 1)
    fraction, exponent = np.frexp(np.maximum(least, 1).astype(np.float64))
    zeros, mantissa = (REST_BITS - exponent).astype(np.int64), ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    return np.where(full, ((zeros + 1) << MANTISSA_BITS) | mantissa, 0).astype(np.uint16)


def bands(registers_: np.ndarray) -> np.ndarray:
    """The 32 band keys of a document's registers."""
    four = registers_.reshape(LANES, PER_LANE)
    which = (four > 0).argmax(axis=1)
    lanes = (which << 14) | four[np.arange(LANES), which]
    full = four.any(axis=1)
    if not full.all():
        own, gone = np.flatnonzero(full), np.flatnonzero(~full)
        lanes[gone] = lanes[own[_BORROW[np.ix_(gone, own)].argmin(axis=1)]]
    return lanes.astype(np.uint16).view("<i8")


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, less what equal registers of different minima add by chance."""
    same = ((x == y) & (x > 0)).sum(axis=-1)
    either = ((x > 0) | (y > 0)).sum(axis=-1)
    return (same / np.maximum(either, 1) - CHANCE) / (1 - CHANCE)


_NO_REGISTERS = bytes(2 * BUCKETS)
_SKETCH = "doc_id bigint, n_shingles bigint, digest binary, registers binary, few binary, bands array<bigint>"


def _sketch(size: int) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingle = Shingler(size)
        for batch in slices(batches):
            rows = []
            for x in texts(batch.column("text")):
                s = shingle(x)
                if len(s):
                    own = registers(s)
                    few = (s >> np.uint64(32)).astype("<u4").tobytes() if len(s) <= FEW else None
                    rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), own.tobytes(), few, bands(own)))
                else:
                    rows.append((0, None, None, None, None))
            columns = [[r[k] for r in rows] for k in range(5)]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            names = ["doc_id", "n_shingles", "digest", "registers", "few", "bands"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return run


def _sets(size: int) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingle = Shingler(size)
        for batch in slices(batches):
            own = [shingle(x).view(np.int64) for x in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(own, pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(x or _NO_REGISTERS for x in column.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def _close_pairs(least: float) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        for batch in slices(batches):
            near = estimate(_matrix(batch.column("a_registers")), _matrix(batch.column("b_registers"))) >= least
            yield batch.select(["a", "b"]).take(np.flatnonzero(near))

    return run


class _Halves:
    """The upper halves of all hashes of short documents, for counting what one document shares with each."""

    def __init__(self, sets: list[bytes | None]):
        self.sets = [None if x is None else np.frombuffer(x, "<u4") for x in sets]
        known = [x if x is not None else np.empty(0, dtype=np.uint32) for x in self.sets]
        values = np.concatenate(known)
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], np.repeat(np.arange(len(known)), [len(x) for x in known])[order]

    def common(self, k: int) -> np.ndarray:
        own = self.sets[k]
        lo, hi = np.searchsorted(self.values, own, "left"), np.searchsorted(self.values, own, "right")
        n = hi - lo
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return np.bincount(self.owners[at], minlength=len(self.sets))


def _close_in_blocks(least: float, percent: int):
    """Pairs of two blocks of one band group: of different components, similar by size and content, not met in an earlier band."""

    def run(table):
        import pyarrow as pa

        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        band = table.column("band")[0].as_py()
        block, node, component, n = (table.column(c).to_numpy() for c in ("block", "node", "component", "n"))
        own, halves = _matrix(table.column("registers")), _Halves(table.column("few").to_pylist())
        short = n <= FEW
        keys = np.array(table.column("bands").to_pylist(), dtype=np.int64)
        xs, ys = np.flatnonzero(block == i), np.flatnonzero(block == j)
        pairs = []
        for x in xs:
            y = ys[(node[ys] > node[x]) if i == j else np.ones(len(ys), dtype=bool)]
            y = y[(component[y] != component[x]) & (np.minimum(n[y], n[x]) * 100 >= percent * np.maximum(n[y], n[x]))]
            if len(y):
                exact = short[y] & short[x]
                near = np.zeros(len(y), dtype=bool)
                near[~exact] = estimate(own[y[~exact]], own[x]) >= least
                if exact.any():
                    common = halves.common(x)[y[exact]] + 1
                    near[exact] = common * 100 >= percent * (n[y[exact]] + n[x] - common)
                y = y[near]
                y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)]
                pairs += [(node[x], node[k]) for k in y]
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


class _Confirm:
    """Pairs of nodes to links: estimates first, then the full sets of the nodes that are left."""

    def __init__(self, nodes: DataFrame, docs: DataFrame, size: int, percent: int):
        self.nodes, self.docs, self.size, self.percent = nodes, docs, size, percent
        self.least = percent / 100 - SLACK

    def estimated(self, pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(self.nodes.select(F.col("node").alias(end), F.col("n").alias(f"{end}_n"), F.col("registers").alias(f"{end}_registers")), end)
        fits = F.least("a_n", "b_n") * 100 >= self.percent * F.greatest("a_n", "b_n")
        return pairs.where(fits).select("a", "b", "a_registers", "b_registers").mapInArrow(frugal(_close_pairs(self.least)), "a bigint, b bigint")

    def linked(self, pairs: DataFrame) -> DataFrame:
        spark, close = pairs.sparkSession, cut(pairs.distinct())
        path = shared_path(spark, "near-ends")
        close.select(F.col("a").alias("node")).unionAll(close.select("b")).distinct().write.parquet(path)
        wanted = spark.read.schema("node bigint").parquet(path)
        ends = self.docs.select(F.col("doc_id").alias("node"), "text").join(wanted, "node", "left_semi")
        sets = cut(ends.mapInArrow(frugal(_sets(self.size)), "node bigint, shingles array<bigint>"))
        for end in ("a", "b"):
            close = close.join(sets.select(F.col("node").alias(end), F.col("shingles").alias(f"{end}_set")), end)
        common = F.size(F.array_intersect("a_set", "b_set")).cast("long")
        union = F.size("a_set") + F.size("b_set") - F.col("common")
        return cut(close.withColumn("common", common).where(F.col("common") * 100 >= self.percent * union).select("a", "b"))


def _unmet(grouped: DataFrame, found: DataFrame, nodes: DataFrame, confirm: _Confirm) -> DataFrame:
    """Pairs within band groups that still hold several components."""
    labelled = cut(grouped.join(found, "node", "left").select("band", "key", "node", F.coalesce("component", "node").alias("component")))
    sizes = labelled.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
    blocks = cut(sizes.where("low < high").select("band", "key", F.ceil(F.col("members") / BLOCK_NODES).cast("int").alias("blocks")))
    rest = labelled.join(blocks, ["band", "key"]).join(nodes, "node")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    needed = F.when(F.col("n") * 100 > FEW * confirm.percent, F.col("registers")).alias("registers")  # whatever fits a shorter one goes by halves too
    rest = rest.select("band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "n", needed, "few", "bands")
    return rest.groupBy("band", "key", "i", "j").applyInArrow(_close_in_blocks(confirm.least, confirm.percent), "a bigint, b bigint")


def _classes(rows: DataFrame) -> DataFrame:
    """doc_id, node, digest: the smallest doc_id of its digest for each row.

    Digests that a ``HOT``-th of all rows or more have are at most ``HOT`` and go to the rows; the others meet theirs in a join.
    """
    firsts = cut(rows.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")))
    every = firsts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.broadcast(firsts.where(F.col("copies") * HOT >= every).where("copies > 1").select("digest", "node"))
    cold = firsts.where((F.col("copies") * HOT < every) | (F.col("copies") == 1)).select("digest", "node")
    rest = rows.join(hot.select("digest"), "digest", "left_anti")
    return rows.join(hot, "digest").unionByName(rest.join(cold, "digest")).select("doc_id", "node", "digest")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    ``size`` words make a shingle; documents link when 100 * common >= ``percent`` * union of their sets.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    path = shared_path(spark, "near-sketches")
    docs.mapInArrow(frugal(_sketch(size)), _SKETCH).write.parquet(path)
    sketches = spark.read.schema(_SKETCH).parquet(path)
    with_set = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")

    classes = cut(_classes(with_set.select("doc_id", "digest")).distinct())
    own = with_set.withColumnsRenamed({"doc_id": "node", "n_shingles": "n"})
    holders = classes.where("doc_id = node").select("node", "digest").distinct()

    slim = own.select("node", "digest", "bands").join(holders, ["node", "digest"], "left_semi").dropDuplicates(["node", "digest"])
    banded = cut(slim.select("node", "bands")).select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").drop("last")
    grouped = cut(banded.join(cut(shared), ["band", "key"]).select("band", "key", "node", "first"))
    met = holders.join(grouped.select("node").distinct(), "node", "left_semi")
    nodes = own.join(met, ["node", "digest"], "left_semi").dropDuplicates(["node", "digest"])
    nodes = cut(nodes.select("node", "n", "registers", "few", "bands"))
    confirm = _Confirm(nodes, docs, size, percent)
    star = grouped.where("first < node").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = confirm.linked(confirm.estimated(star)).unionAll(classes.where("doc_id > node").select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    found = components(links)
    more = confirm.linked(_unmet(grouped, found, nodes, confirm))
    if not more.isEmpty():
        found = components(links.unionAll(more))
    return sketches.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
    )


def _copy_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one key for rows of the same doc_id and text; rows without an id are copies by text alone."""
    name = unused(docs.columns, "key")["key"]
    digest = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    return docs.withColumn(name, F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)), name


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near duplicates, and of exact copies among these the smallest row."""
    gone = near_duplicates(docs, size, percent).where("NOT kept").select("doc_id").distinct()
    keyed, key = _copy_key(docs)
    repeated = cut(keyed.groupBy(key).count().where("count > 1").select(key))  # keys only: no text is shuffled for it
    if repeated.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    kept = keyed.join(gone, "doc_id", "left_anti")
    copies = kept.join(repeated, key, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return kept.join(repeated, key, "left_anti").select(*docs.columns).unionAll(copies.select("row.*"))
