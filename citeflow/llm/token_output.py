"""Token ids as Re-Pair compressed shards.

Documents are dealt out in ranges of doc_id and sorted; a task encodes its documents in order and closes a shard
after ``SHARD_IDS`` ids. In each shard the most frequent pairs of neighbouring symbols are replaced by nonterminals and
the pairs of what is left counted anew, until no pair occurs ``LEAST_COUNT`` times or the symbols are used up; a round
replaces the ``PAIRS_PER_ROUND`` most frequent pairs at once. A shard stores its rules, the expansion length of every rule, the symbol sequence, and where each
document begins in it, so one document (or one token of it) is decoded without expanding the rest. Shards are rows of
a Parquet table in the folder given: Spark's committer makes the write safe against lost tasks.

Shard layout, little-endian: magic ``RPG1``, then uint32 n_docs, base, n_rules, n_symbols, then int64 doc_id[n_docs],
uint8 doc_id_is_null[n_docs], uint32 first_symbol[n_docs + 1], uint32 n_ids[n_docs], uint16 left[n_rules],
uint16 right[n_rules], uint32 expansion_length[n_rules], uint16 symbols[n_symbols]. Symbols below ``base`` are ids.

Defined results: a null or empty text holds the end id alone; rows with a null doc_id come first, with a null doc_id;
rows with one doc_id (repeated rows too) follow each other in an order of their own (the text's); an empty table gives no shards; longer
texts than a shard make a longer shard; further columns are ignored.
"""

from __future__ import annotations

import codecs
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm.common import frugal, give_back, kept, shared_path, slices, texts
from citeflow.llm.token_counts import load_tokenizer

END_ID = 2
SHARD_IDS = 1 << 20
CACHE_ENTRIES = 120_000
BLOCK_BYTES = 1 << 22
MERGED_AT_ONCE = 16_384
PAIRS_PER_ROUND = 8192
LEAST_COUNT = 16
MAX_SYMBOL = 1 << 16


#: What the shortcut below was written for, as the tokenizer's file has it (fixed values).
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The same for texts of code points up to U+00FF, which NFC leaves as they are, as Latin-1 bytes: lower-cased, and what each byte is.
_LOWER = "".join(map(chr, range(256))).lower().encode("latin-1")
_SPACES = b"\t\n\v\f\r \x85\xa0"
_SPACE, _LETTER, _FIGURE, _OTHER = range(4)
_KINDS = bytes(_SPACE if c in _SPACES else _LETTER if chr(c).isalpha() else _FIGURE if chr(c).isnumeric() else _OTHER for c in range(256))
_QUOTE, _SHORT, _LONG = ord("'"), b"stmd", (b"re", b"ve", b"ll")


def _pre_tokens(lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of lower-cased Latin-1 text begin, and their lengths. The text ends with two spaces."""
    given, kind = np.frombuffer(lowered, np.uint8), np.frombuffer(lowered.translate(_KINDS), np.uint8)
    begins = kind == _FIGURE
    begins[0] = True
    begins[1:] |= kind[1:] != kind[:-1]
    quote = np.flatnonzero((given == _QUOTE) & begins)
    if len(quote):
        one, two = given[quote + 1], given[quote + 2]
        short = quote[np.isin(one, list(_SHORT))]
        long = quote[np.any([(one == a) & (two == b) for a, b in _LONG], axis=0)]
        begins[short + 1] = begins[long + 1] = False
        begins[short + 2] = begins[long + 3] = True
    first = np.flatnonzero(begins)
    size = np.diff(first, append=len(given))
    real = kind[first] != _SPACE
    return first[real], size[real]


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others as code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder(dict):
    """Texts to ids as uint16 bytes; as a mapping, lower-cased pre-tokens (in Latin-1) to theirs.

    Texts of code points up to U+00FF are split here, many at once, and each different pre-token meets the library's merges.
    The first pre-tokens, twice ``limit`` of them, are kept until more than three quarters of a block's are not among them.
    Other texts, those with an added token in them, and all texts of a tokenizer with other settings go through the whole library.
    """

    def __init__(self, path: str, limit: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        super().__init__()
        self.tokenizer = load_tokenizer(path)
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = WhitespaceSplit()
        self.limit = 2 * limit
        letters = _byte_letters()
        self.letters = "".join({**letters, ord(" "): " "}[b] for b in range(256))
        made = json.loads(self.tokenizer.to_str())
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added), re.IGNORECASE) if added else None
        vocabulary, suffix = self.tokenizer.get_vocab(with_added_tokens=False), made["model"].get("end_of_word_suffix")
        #: Whether an id ends its pre-token, which one id of each does if every byte has an id for its end.
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[k for token, k in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        marked = suffix and all(x in vocabulary and x + suffix in vocabulary for x in letters.values())
        settings = made["normalizer"].get("normalizers"), made["pre_tokenizer"]["pretokenizers"][0]["pattern"]
        self.plain = bool(marked) and settings == (_NORMAL, {"Regex": _SPLIT})

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token by the library's merges, which get ``MERGED_AT_ONCE`` of them in one text, with spaces between."""
        out = []
        for k in range(0, len(pieces), MERGED_AT_ONCE):
            shown, _ = codecs.charmap_decode(b" ".join(pieces[k : k + MERGED_AT_ONCE]).decode("latin-1").encode(), "strict", self.letters)
            (found,) = self.merger.encode_batch_fast([shown], add_special_tokens=False)
            ids = np.array(found.ids, dtype=np.uint16)
            ends = (2 * np.flatnonzero(self.last[ids]) + 2).tolist()
            every = ids.tobytes()
            out += [every[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def look_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of these different pre-tokens."""
        out = list(map(self.get, pieces))
        absent = [k for k, ids in enumerate(out) if ids is None]
        if len(self) >= self.limit and 4 * len(absent) > 3 * len(pieces):
            self.clear()
        unseen = [pieces[k] for k in absent]
        fresh = self.merged(unseen)
        for k, ids in zip(absent, fresh, strict=True):
            out[k] = ids
        room = max(0, self.limit - len(self))
        self.update(zip(unseen[:room], fresh[:room], strict=True))
        return out

    def encode(self, raw: bytes) -> bytes:
        return self.encode_all([raw])[0]

    def encode_all(self, raws: list[bytes]) -> list[bytes]:
        """The ids of each text; texts go in blocks of ``BLOCK_BYTES``, and each different pre-token of a block is looked up once."""
        out, narrow, size = [], [], 0
        library: dict[int, bytes] = {}
        for k, raw in enumerate(raws):
            text = raw.decode("utf-8", "replace")
            own = None
            if self.plain and not (self.added and self.added.search(text)):
                try:
                    own = text.encode("latin-1")
                except UnicodeEncodeError:
                    pass
            if own is None:
                library[k] = array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            narrow.append(own or b"")
            size += len(narrow[-1])
            if size >= BLOCK_BYTES or k == len(raws) - 1:
                out += self._narrow(narrow)
                narrow, size = [], 0
        for k, ids in library.items():
            out[k] = ids
        return out

    def _narrow(self, texts: list[bytes]) -> list[bytes]:
        import pyarrow as pa

        lowered = b" ".join([*texts, b"", b""]).translate(_LOWER)
        first, size = _pre_tokens(lowered)
        if not len(first):
            return [b""] * len(texts)
        kind = pa.large_binary()
        parts = [None, pa.py_buffer(np.concatenate(([0], np.cumsum(size)))), pa.py_buffer(lowered.translate(None, _SPACES))]
        pieces = pa.Array.from_buffers(kind, len(size), parts).dictionary_encode()
        known = _values(pieces.dictionary, np.arange(len(pieces.dictionary) + 1))
        ids = pa.array(self.look_up(known), kind).take(pieces.indices)
        return _values(ids, np.concatenate(([0], np.searchsorted(first, np.cumsum([len(x) + 1 for x in texts])))))


def _values(column, borders: np.ndarray) -> list[bytes]:
    """The bytes of an Arrow column of large binaries from each border to the next."""
    _, offsets, data = column.buffers()
    at, every = np.frombuffer(offsets, np.int64)[column.offset :][borders].tolist(), data.to_pybytes()
    return [every[a:b] for a, b in zip(at, at[1:], strict=False)]


def _encoder(path: str) -> Encoder:
    """One tokenizer for a worker process's tasks, as long as these are of this kind."""
    return kept(_name(path), lambda: Encoder(path))


def _name(path: str) -> str:
    return f"encoder {path}"


def _replace(symbols: np.ndarray, inner: np.ndarray, chosen: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Replaces the chosen pairs from left to right, without overlap. inner[i]: symbol i + 1 is of the same document."""
    a, b = chosen >> 16, chosen & 0xFFFF
    row, column = np.zeros(MAX_SYMBOL, dtype=np.int32), np.zeros(MAX_SYMBOL, dtype=np.int32)
    lefts, rights = np.unique(a), np.unique(b)
    row[lefts], column[rights] = np.arange(1, len(lefts) + 1), np.arange(1, len(rights) + 1)
    rules = np.zeros((len(lefts) + 1, len(rights) + 1), dtype=np.uint16)
    rules[row[a], column[b]] = np.arange(1, len(chosen) + 1)
    rule = rules.reshape(-1)[row[symbols[:-1]] * (len(rights) + 1) + column[symbols[1:]]]
    at = np.flatnonzero((rule > 0) & inner[:-1])
    rule = rule[at].astype(np.int64) - 1
    if not len(at):
        return symbols, inner
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    np.not_equal(np.diff(at), 1, out=new[1:])
    run = np.flatnonzero(new)
    odd = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) & 1
    at, rule = at[odd == 0], rule[odd == 0]
    out = symbols.copy()
    out[at] = (first + rule).astype(np.uint16)
    inner = inner.copy()
    inner[at] = inner[at + 1]
    keep = np.ones(len(symbols), dtype=bool)
    keep[at + 1] = False
    return out[keep], inner[keep]


def compress(ids: np.ndarray, n_ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first symbol of each document, left, right, expansion length) for documents laid end to end."""
    symbols = ids.astype(np.uint16)
    inner = np.ones(len(ids), dtype=bool)
    inner[np.cumsum(n_ids) - 1] = False
    left, right = [np.empty(0, np.uint16)], [np.empty(0, np.uint16)]
    length = np.ones(MAX_SYMBOL, dtype=np.uint32)
    used = base
    while used < MAX_SYMBOL and len(symbols) > 1:
        room = min(PAIRS_PER_ROUND, MAX_SYMBOL - used)
        keys = (symbols[:-1].astype(np.uint32) << 16) | symbols[1:]
        ordered = np.sort(keys[inner[:-1]])
        if not len(ordered):
            break
        edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(edges, len(ordered)))
        frequent = np.flatnonzero(counts >= LEAST_COUNT)
        if not len(frequent):
            break
        best = frequent[np.lexsort((ordered[edges[frequent]], -counts[frequent]))[:room]]
        chosen = np.sort(ordered[edges[best]])
        symbols, inner = _replace(symbols, inner, chosen, used)
        a, b = (chosen >> 16).astype(np.uint16), (chosen & 0xFFFF).astype(np.uint16)
        left.append(a)
        right.append(b)
        length[used : used + len(chosen)] = length[a] + length[b]
        used += len(chosen)
    ends = np.flatnonzero(~inner) + 1
    return symbols, np.concatenate(([0], ends)).astype(np.uint32), np.concatenate(left), np.concatenate(right), length[base:used]


def pack(doc_ids: list[int | None], ids: np.ndarray, n_ids: np.ndarray, base: int) -> bytes:
    symbols, first, left, right, length = compress(ids, n_ids, base)
    head = np.array([len(doc_ids), base, len(left), len(symbols)], dtype="<u4")
    numbers = np.array([0 if x is None else x for x in doc_ids], dtype="<i8")
    absent = np.array([x is None for x in doc_ids], dtype=np.uint8)
    parts = [head, numbers, absent, first.astype("<u4"), n_ids.astype("<u4"), left.astype("<u2"), right.astype("<u2"), length.astype("<u4"), symbols.astype("<u2")]
    return b"RPG1" + b"".join(x.tobytes() for x in parts)


class Shard:
    """Random access to a packed shard."""

    def __init__(self, blob: bytes):
        if blob[:4] != b"RPG1":
            raise ValueError("not a shard")
        n, self.base, rules, symbols = np.frombuffer(blob, "<u4", 4, 4).tolist()
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, count, at)
            at += out.nbytes
            return out

        numbers, absent = take("<i8", n), take("u1", n)
        self.doc_ids = [None if gone else x for x, gone in zip(numbers.tolist(), absent, strict=True)]
        self.first, self.n_ids = take("<u4", n + 1), take("<u4", n)
        self.left, self.right, rule_length, self.symbols = take("<u2", rules), take("<u2", rules), take("<u4", rules), take("<u2", symbols)
        self.length = np.concatenate((np.ones(self.base, dtype=np.int64), rule_length.astype(np.int64)))
        self._flat: tuple[np.ndarray, np.ndarray] | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All rules' expansions end to end after the ids themselves, and where each symbol's begins."""
        if self._flat is None:
            begin = np.concatenate(([0], np.cumsum(self.length)))
            flat = np.empty(int(begin[-1]), dtype=np.uint32)
            flat[: self.base] = np.arange(self.base)
            for k, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True), self.base):
                middle = begin[k] + self.length[a]
                flat[begin[k] : middle] = flat[begin[a] : begin[a + 1]]
                flat[middle : begin[k + 1]] = flat[begin[b] : begin[b + 1]]
            self._flat = flat, begin
        return self._flat

    def ids(self, k: int) -> np.ndarray:
        """The ids of the shard's k-th document."""
        return self._expanded(self.symbols[self.first[k] : self.first[k + 1]])

    def all_ids(self) -> np.ndarray:
        """The ids of all documents of the shard, end to end."""
        return self._expanded(self.symbols)

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        flat, begin = self._expansions()
        sizes = self.length[symbols]
        jump = np.repeat(begin[symbols] - (np.cumsum(sizes) - sizes), sizes)
        return flat[jump + np.arange(len(jump))]

    def token(self, k: int, i: int) -> int:
        """The i-th id of the k-th document, by expansion lengths alone."""
        symbols = self.symbols[self.first[k] : self.first[k + 1]]
        ends = np.cumsum(self.length[symbols])
        at = int(np.searchsorted(ends, i, "right"))
        symbol, i = int(symbols[at]), int(i - (ends[at] - self.length[symbols[at]]))
        while symbol >= self.base:
            a, b = int(self.left[symbol - self.base]), int(self.right[symbol - self.base])
            symbol, i = (a, i) if i < self.length[a] else (b, int(i - self.length[a]))
        return symbol


_TABLE = "part int, part_start bigint, n_docs bigint, n_ids bigint, shard binary"


def _encode(path: str, doc_id: str, text: str) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, end = _encoder(path), np.array([END_ID], dtype="<u2").tobytes()
        base = encoder.tokenizer.get_vocab_size()
        part, done = TaskContext.get().partitionId(), 0
        numbers: list[int | None] = []
        encoded: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal done, size
            n_ids = np.array([len(x) // 2 for x in encoded], dtype=np.int64)
            blob = pack(numbers, np.frombuffer(b"".join(encoded), "<u2"), n_ids, base)
            row = [[part], [done], [len(numbers)], [int(n_ids.sum())], [blob]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            done, size = done + int(n_ids.sum()), 0
            numbers.clear()
            encoded.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["part", "part_start", "n_docs", "n_ids", "shard"])

        for batch in slices(batches):
            for number, ids in zip(batch.column(doc_id).to_pylist(), encoder.encode_all(texts(batch.column(text))), strict=True):
                numbers.append(number)
                encoded.append(ids + end)
                size += len(encoded[-1]) // 2
                if size >= SHARD_IDS:
                    yield shard()
                    give_back()
        if numbers:
            yield shard()

    return run


def write_token_shards(docs: DataFrame, tokenizer_path: str, out: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes ``docs`` as shards under ``out``, in ascending order of doc_id."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(frugal(_encode(tokenizer_path, "doc_id", "text"), _name(tokenizer_path)), _TABLE).write.option("compression", "zstd").parquet(out)


def _digest(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for start, blob in zip(batch.column("start").to_pylist(), batch.column("shard").to_pylist(), strict=True):
            shard = Shard(blob)
            sizes = shard.n_ids.astype(np.int64)
            ends = np.cumsum(sizes)
            every = memoryview(shard.all_ids().astype("<u4")).cast("B")
            crc = [zlib.crc32(every[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
            starts = start + ends - sizes
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the ids before each: what a task wrote before it, and the parts before its own.

    One number for each write task comes to the driver; their count is that of the partitions, not of the rows.
    """
    import pyarrow as pa

    shards = spark.read.schema(_TABLE).parquet(path)
    totals = sorted(shards.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_ids"))).collect())
    before, offsets = 0, []
    for part, total in totals:
        offsets.append((part, before))
        before += total
    columns = [pa.array([x[k] for x in offsets], kind) for k, kind in enumerate((pa.int32(), pa.int64()))]
    known = F.broadcast(spark.createDataFrame(pa.table(columns, names=["part", "before"])))  # a list of rows would take Python workers of its own
    return shards.join(known, "part").withColumn("start", F.col("before") + F.col("part_start"))


def token_output(docs: DataFrame, tokenizer_path: str, out: str | None = None) -> DataFrame:
    """Writes the shards, reads them back, and returns doc_id, start, n_tokens and ids_crc32 of what was read."""
    spark = docs.sparkSession
    out = out or shared_path(spark, "token-shards")
    write_token_shards(docs, tokenizer_path, out)
    return read_token_shards(spark, out).select("start", "shard").mapInArrow(frugal(_digest, _name(tokenizer_path)), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
