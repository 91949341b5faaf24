"""Token counts of whole texts, with the library's byte-level BPE.

Offline (once, on the driver, from the vocabulary file alone) every vocabulary string is encoded by itself; those that
come out as one pre-token and one id are proven whole tokens, a list bounded by the vocabulary that goes to the tasks. A text is split into pre-tokens; a proven one counts 1, and
only the others go through the merges, one by one through the library, with their counts kept in a bounded table.

Defined results: a null or empty text has 0 bytes and 0 tokens; added tokens inside a text count as the library's
default has it (one id each); texts of any length are counted whole; every row is counted on its own, repeated or
not; an empty table gives no rows; further columns are ignored. A text with code points that this Python's Unicode tables do not know is left to
the library as a whole, because the pre-token borders could differ there.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import slices, texts

CACHE_ENTRIES = 150_000
OVER_LIMIT = 1024

#: Added to a text's count for each pre-token that only the library may judge.
_ODD = -(1 << 50)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def proven_whole(tokenizer) -> dict[str, int]:
    """Vocabulary strings that the tokenizer, given nothing else, turns into exactly one pre-token and one id."""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ids = sorted(set(tokenizer.get_vocab().values()))
    strings = [s for s in tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False) if s and "�" not in s and s not in special]
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return {s: 1 for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1 and len(tokenizer.pre_tokenizer.pre_tokenize_str(s)) == 1}


@functools.cache
def proven_at(path: str) -> dict[str, int]:
    return proven_whole(load_tokenizer(path))


class Counts(dict):
    """Pre-token to number of ids: the proven ones for good, merged ones up to ``limit``."""

    def __init__(self, tokenizer, whole: dict[str, int], limit: int = CACHE_ENTRIES):
        self.tokenizer, self.whole = tokenizer, whole
        super().__init__(self.whole)
        self.limit = limit + len(self.whole)

    def __missing__(self, piece: str) -> int:
        if not piece.isascii() and any(unicodedata.category(c) == "Cn" for c in piece):
            return _ODD
        if len(self) >= self.limit:
            self.clear()
            self.update(self.whole)
        self[piece] = n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return n


class Counter:
    """Counts tokens of whole texts; ``count`` equals ``len(tokenizer.encode(text, add_special_tokens=False).ids)``."""

    def __init__(self, path: str, limit: int = CACHE_ENTRIES, whole: dict[str, int] | None = None):
        import public_tokenizers
        import regex

        self.tokenizer = load_tokenizer(path)
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.counts = Counts(self.tokenizer, proven_at(path) if whole is None else whole, limit)
        special = [regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(special)) if special else None

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        one, find, total = self.counts.__getitem__, self.find, len(parts) - 1
        for part in parts:
            total += sum(map(one, find(part)))
        return total if total >= 0 else len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _count(path: str, whole: dict[str, int], keep: list[str], text: str) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counter = Counter(path, whole=whole)
        for batch in slices(batches):
            own = texts(batch.column(text))
            tokens = [counter.count(x.decode("utf-8", "replace")) if x else 0 for x in own]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([len(x) for x in own], pa.int64()), pa.array(tokens, pa.int64())],
                names=[*keep, "__n_bytes", "__n_tokens"],
            )

    return run


def count_tokens(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with ``__n_bytes`` and ``__n_tokens``; one pass, nothing shuffled."""
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(_count(path, proven_at(path), keep, text), f"{kinds}__n_bytes bigint, __n_tokens bigint")


def token_counts(docs: DataFrame, path: str, limit: int = OVER_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    counted = count_tokens(docs, path, ["doc_id"])
    return counted.select("doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_tokens").alias("n_tokens"), (F.col("__n_tokens") > limit).alias("over_limit"))
