"""Benchmark decontamination with suffix arrays over the training text.

Each task turns its documents into word ids of the benchmark's own vocabulary and gathers them in shards of about
``SHARD_WORDS`` words. Stretches of known words that are long enough for a window are laid end to end, and all their
suffixes are sorted, by prefix doubling, into the shard's suffix array. Every suffix of every benchmark item is then
found by binary search, word after word: its range in the array shrinks until no word fits, which gives the longest
verbatim match and its places; the range where the suffix has held a whole window gives all occurrences of it.
Neighbouring occurrences of neighbouring suffixes are one match; a document is hit where matches cover it.

Nothing of the corpus is shuffled: the benchmark is the stated query set, and goes to the tasks in blocks of at most
``BLOCK_BYTES`` of text, one pass over the documents for each; between two passes the documents and what was found are
written, so a stage holds one block.

Defined results: a null or empty text has no words and is never contaminated; texts of any length are read whole; an
item without words has no window; repeated documents and items are each treated on their own (an item id that occurs
twice counts once); items without an id are searched like the others, count as one item and are not listed; of equally
long matches the first in the document counts, then the smallest item id and the first place there; an empty table of
documents gives no rows, an empty benchmark hits nothing; further columns of either table are ignored, or kept when
rows are returned, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import cut, frugal, slices, texts, unused

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 20
#: Occurrences of item suffixes that are held at once.
MOST_PAIRS = 1 << 22

#: Letters and digits stay (A-Z lower-cased), bytes above 0x7F stay, all else separates words.
_KEEP = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def _runs(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n[0] - 1, 0, 1, ... n[1] - 1, and so on."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


class Block:
    """One block of the benchmark: its vocabulary, and its items' words end to end."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.names, ids = [], []
        for name, text in sorted(items, key=lambda x: (x[0] is not None, x[0] or "", x[1])):
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if own:
                self.names.append(name)
                ids.append(np.array(own, dtype=np.int32))
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        self.words = np.concatenate([np.empty(0, dtype=np.int32), *ids])
        self.item, self.at = np.repeat(np.arange(len(ids)), sizes), _runs(sizes)
        self.left = np.repeat(sizes, sizes) - self.at
        #: The words of the window that begins at each place; 0 where none does.
        size = np.repeat(np.minimum(sizes, window), sizes)
        self.window = np.where(self.left >= size, size, 0)
        self.shortest = int(np.minimum(sizes, window).min()) if ids else 0


class Shard:
    """Stretches of known words with their suffix array."""

    def __init__(self, ids: np.ndarray, shortest: int):
        ends = np.append(np.flatnonzero(ids == 0), len(ids))
        starts = np.append(0, ends[:-1] + 1)
        long = ends - starts >= max(1, shortest)
        starts, sizes = starts[long], (ends - starts)[long]
        #: Words, each stretch with a 0 behind it, and where they are in ``ids``.
        self.place = np.repeat(starts, sizes + 1) + _runs(sizes + 1)
        self.words = np.append(ids, np.int32(0))[self.place]
        self.left = np.repeat(sizes, sizes + 1) - _runs(sizes + 1)
        self.array = self._sorted(int(sizes.max(initial=0)))

    def _sorted(self, longest: int) -> np.ndarray:
        rank, n, step = self.words.astype(np.int64), len(self.words), 1
        here = np.arange(n)
        while step < longest:
            after = np.where(self.left > step, rank[np.minimum(here + step, n - 1)], 0)
            ranks, new = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)
            rank, step = new.astype(np.int64) + (self.words.min() > 0), 2 * step
            if len(ranks) == n:
                break
        order = np.argsort(rank, kind="stable")
        return order[self.words[order] > 0]

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
        """In each range of suffixes that agree in ``depth`` words, the first with a next word not below (above) ``word``."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            there = self.words[self.array[middle] + depth]
            below = there <= word[open_] if right else there < word[open_]
            low[open_[below]], high[open_[~below]] = middle[below] + 1, middle[~below]
        return low

    def search(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of every item suffix: the words of its longest match and one place of it, and the array's range that holds its window."""
        n = len(block.words)
        longest, first, low, high = np.zeros(n, dtype=np.int64), np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        live, a, b = np.arange(n), np.zeros(n, dtype=np.int64), np.full(n, len(self.array))
        depth = 0
        while live.size:
            word = block.words[live + depth]
            a, b = self._bound(a, b, depth, word, False), self._bound(a, b, depth, word, True)
            depth += 1
            found = a < b
            live, a, b = live[found], a[found], b[found]
            longest[live], first[live] = depth, self.array[a]
            whole = block.window[live] == depth
            low[live[whole]], high[live[whole]] = a[whole], b[whole]
            more = block.left[live] > depth
            live, a, b = live[more], a[more], b[more]
        return longest, first, low, high


def _extended(shard: Shard, block: Block, place: np.ndarray, suffix: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Matches that end where the pairs held at once do go on in the next ones."""
    live = np.arange(len(words))
    while live.size:
        live = live[(words[live] < shard.left[place[live]]) & (words[live] < block.left[suffix[live]])]
        live = live[shard.words[place[live] + words[live]] == block.words[suffix[live] + words[live]]]
        words[live] += 1
    return words


def _matches(shard: Shard, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Maximal matches that hold a window: place in the shard's words, place in the block's words, number of words."""
    _, _, low, high = shard.search(block)
    held = np.flatnonzero(high > low)
    counts = (high - low)[held]
    cuts = np.searchsorted(np.cumsum(counts), np.arange(MOST_PAIRS, counts.sum() + MOST_PAIRS, MOST_PAIRS)) + 1 if len(held) else []
    at = 0
    for end in [min(int(c), len(held)) for c in cuts]:
        own, n = held[at:end], counts[at:end]
        at = end
        suffix, place = np.repeat(own, n), shard.array[np.repeat(low[own], n) + _runs(n)]
        order = np.lexsort((place, place - suffix))
        suffix, place = suffix[order], place[order]
        begins = np.concatenate(([True], (np.diff(place) != 1) | (np.diff(suffix) != 1) | (block.item[suffix[1:]] != block.item[suffix[:-1]])))
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(place)) - 1
        if len(first):
            place, suffix, words = place[first], suffix[first], place[last] - place[first] + block.window[suffix[last]]
            yield place, suffix, _extended(shard, block, place, suffix, words)


_NONE = {"words": 0, "at": None, "item": None, "item_at": None}


def scan_shard(block: Block, ids: list[np.ndarray]) -> tuple[list[list[tuple[int, int]]], list[set], list[dict]]:
    """For each document: its disjoint hit ranges of words, the items found, and its longest match."""
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    offsets = np.cumsum(sizes + 1) - sizes - 1
    joined = np.concatenate([np.append(x, np.int32(0)) for x in ids])
    ranges: list[list[tuple[int, int]]] = [[] for _ in ids]
    items: list[set] = [set() for _ in ids]
    longest = [dict(_NONE) for _ in ids]
    shard = Shard(joined, block.shortest)
    if not block.shortest or not len(shard.array):
        return ranges, items, longest
    edge = np.zeros(len(joined) + 1, dtype=np.int64)
    for place, suffix, words in _matches(shard, block):
        at = shard.place[place]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + words, -1)
        doc = np.searchsorted(offsets, at, "right") - 1
        item = block.item[suffix]
        for k, i in np.unique(np.stack([doc, item], axis=1), axis=0).tolist():
            items[k].add(block.names[i])
        order = np.lexsort((block.at[suffix], item, at, -words, doc))
        for k in order[np.flatnonzero(np.diff(doc[order], prepend=-1))].tolist():
            d = int(doc[k])
            new = {"words": int(words[k]), "at": int(at[k] - offsets[d]), "item": block.names[item[k]], "item_at": int(block.at[suffix[k]])}
            longest[d] = _longer(longest[d], new)
    hit = np.diff(np.concatenate(([0], np.cumsum(edge) > 0, [0])).astype(np.int8))
    for a, b in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist(), strict=True):
        k = int(np.searchsorted(offsets, a, "right")) - 1
        ranges[k].append((int(a - offsets[k]), int(b - offsets[k])))
    return ranges, items, longest


def _longer(x: dict, y: dict) -> dict:
    def order(m: dict) -> tuple:
        return -m["words"], m["at"], m["item"] is not None, m["item"] or "", m["item_at"]

    return y if not x["words"] or (y["words"] and order(y) < order(x)) else x


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_KINDS = "bigint", "array<struct<start: int, end: int>>", "array<string>", "struct<words: int, at: int, item: string, item_at: int>"


def _scan(block: Block, keep: list[str], text: str, before: list[str]) -> Callable[[Iterator], Iterator]:
    """Adds what this block finds to what earlier blocks found (the columns ``before``)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [
            pa.int64(),
            pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
            pa.list_(pa.string()),
            pa.struct([("words", pa.int32()), ("at", pa.int32()), ("item", pa.string()), ("item_at", pa.int32())]),
        ]
        get = block.vocabulary.get
        held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []
        size = 0

        def flush() -> Iterator:
            nonlocal size
            ranges, items, longest = scan_shard(block, [x for _, own in held for x in own])
            k = 0
            for batch, own in held:
                at, k = k, k + len(own)
                found, names, best = ranges[at:k], items[at:k], longest[at:k]
                if before:
                    earlier = zip(*(batch.column(c).to_pylist() for c in before[1:]), strict=True)
                    for j, (r, i, x) in enumerate(earlier):
                        found[j] = _merged(found[j] + [(y["start"], y["end"]) for y in r])
                        names[j] |= set(i)
                        best[j] = _longer(x, best[j])
                values = [len(x) for x in own], [[{"start": a, "end": b} for a, b in x] for x in found], [sorted(x, key=lambda n: (n is not None, n or "")) for x in names], best
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(v, kind) for v, kind in zip(values, kinds, strict=True))], names=[str(j) for j in range(len(keep) + 4)])
            held.clear()
            size = 0

        for batch in slices(batches):
            own = []
            for x in texts(batch.column(text)):
                words = words_of(x)
                own.append(np.fromiter(map(get, words, repeat(0)), dtype=np.int32, count=len(words)))
                size += len(words)
            held.append((batch.select(list(dict.fromkeys([*keep, *before]))), own))
            if size >= SHARD_WORDS:
                yield from flush()
        if held:
            yield from flush()

    return run


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id", window: int = WINDOW) -> tuple[DataFrame, dict[str, str]]:
    """``keep`` columns of ``docs`` with those of the dictionary: n_words, ranges (hit words, disjoint), items, longest."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    names = unused(docs.columns, "n_words", "ranges", "items", "longest")
    out, before = docs.select(*dict.fromkeys([*keep, text])), []
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        carried = keep if b == blocks - 1 else list(dict.fromkeys([*keep, text]))
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carried).schema] + [f"`{n}` {k}" for n, k in zip(names.values(), _KINDS, strict=True)]
        out = out.mapInArrow(frugal(_scan(Block([(r["item"], bytes(r["text"])) for r in own], window), carried, text, before)), ", ".join(kinds))
        before = list(names.values())
        out = cut(out) if b < blocks - 1 else out
    return out, names


def _overlap(names: dict[str, str]) -> tuple:
    """The number of hit words, and the verdict."""
    hit = F.aggregate(names["ranges"], F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]).cast("long"))
    return hit, (hit > 0) & (hit * 20 >= F.col(names["n_words"]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents of which at least a twentieth of the words lies in benchmark windows."""
    found, names = scan(docs, benchmark, docs.columns, text, item, window)
    return found.where(~_overlap(names)[1]).select(*docs.columns)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found (count and digest), the verdict, and the longest match with its places."""
    found, names = scan(docs, benchmark, ["doc_id"])
    hit, contaminated = _overlap(names)
    listed = F.array_join(names["items"], ",")
    return found.select(
        "doc_id",
        F.col(names["n_words"]).alias("n_words"),
        hit.alias("n_hit"),
        F.size(names["items"]).cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        contaminated.alias("contaminated"),
        *(F.col(f"{names['longest']}.{c}").alias(f"longest_{c}") for c in ("words", "at", "item", "item_at")),
    )
