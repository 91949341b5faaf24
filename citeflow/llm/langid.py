"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, what is no letter becomes one space, and all n-grams of one to three characters are hashed into
``FEATURES`` features; a feature's value is its share of the text's n-grams times its inverse document frequency,
which is counted over all labelled training documents. Weights are learned with follow-the-regularised-leader
(proximal, per coordinate, with elastic-net penalties) from at most ``SAMPLE`` labelled documents, chosen by a hash
and spread over the languages; a fifth of these is held back to fit the temperature that calibrates the scores.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any labelled training document
every text is ``und``; rows are judged one by one, repeated or not, whole however long; of equally likely languages the
first by name is taken; an empty table gives no rows; further columns are ignored, or kept when rows are returned,
whatever their names; a null lang teaches nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import crc_bucket, frugal, slices, texts, unused

FEATURES = 1 << 15
SAMPLE = 4096
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
#: Shares are small numbers; this puts values near 1.
GAIN = 50.0
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_SPACE_BELOW = 0x250
_SPACES = np.array([not chr(c).isalpha() for c in range(_SPACE_BELOW)])


def ngrams(text: str) -> np.ndarray:
    """The hashed features of all n-grams of a text, one for each occurrence."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    low = codes < _SPACE_BELOW
    space = np.where(low, _SPACES[np.where(low, codes, 0)], (codes >= 0x2000) & (codes < 0x2070))
    codes = np.where(space, np.uint32(32), codes)
    keep = ~space
    keep[1:] |= ~space[:-1]
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
    one = (codes + np.uint32(1)) * np.uint32(2654435761)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(2246822519) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(3266489917) + one[2:]
    every = np.concatenate((one, two, three))
    return ((every ^ (every >> np.uint32(16))) * np.uint32(668265263)) >> np.uint32(32 - FEATURES.bit_length() + 1)


def _has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def _frequencies(batches: Iterator) -> Iterator:
    """In how many of a task's documents each feature occurs."""
    import pyarrow as pa

    total, seen = np.zeros(FEATURES, dtype=np.int64), np.zeros(FEATURES, dtype=np.int64)
    for batch in slices(batches):
        for x in texts(batch.column("text")):
            text = x.decode("utf-8", "replace")
            if _has_letter(text):
                seen[:] = 0
                seen[ngrams(text)] = 1
                total += seen
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["feature", "n"])


def _shares(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in slices(batches, 256):
        langs, features, shares = [], [], []
        for lang, x in zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True):
            text = x.decode("utf-8", "replace")
            if _has_letter(text):
                f, n = np.unique(ngrams(text), return_counts=True)
                langs.append(lang)
                features.append(f.astype("<i4").tobytes())
                shares.append((n / n.sum()).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(features, pa.binary()), pa.array(shares, pa.binary())], names=["lang", "features", "shares"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Follow the regularised leader, one weight vector for each language; the last feature is the bias."""

    def __init__(self, classes: int):
        self.z = np.zeros((FEATURES + 1, classes))
        self.n = np.zeros((FEATURES + 1, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = _softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by ever finer grids."""
    if not len(labels):
        return 1.0
    low, high = -5.0, 5.0
    for _ in range(6):
        grid = np.linspace(low, high, 21)
        loss = [-np.log(_softmax(scores / np.exp(t))[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
        k = int(np.argmin(loss))
        low, high = grid[max(k - 1, 0)], grid[min(k + 1, 20)]
    return float(np.exp((low + high) / 2))


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.langs, self.weights, self.bias, self.temperature = langs, weights.astype(np.float32), bias, temperature

    def predict(self, text: str) -> tuple[str, float]:
        if not self.langs or not _has_letter(text):
            return UNKNOWN, 0.0
        at = ngrams(text)
        p = _softmax((self.weights[at].sum(axis=0, dtype=np.float64) / len(at) + self.bias) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from ``text`` and ``lang`` of ``labelled``, which must hold training documents only (and ``doc_id``)."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    per_lang = dict(labelled.groupBy("lang").count().collect())
    if not per_lang:
        return Model([], np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    df = np.zeros(FEATURES)
    for feature, n in labelled.select("text").mapInArrow(frugal(_frequencies), "feature int, n bigint").groupBy("feature").agg(F.sum("n")).collect():
        df[feature] = n
    idf = np.log((1 + sum(per_lang.values())) / (1 + df)) + 1
    quota, share = sample / len(per_lang), F.lit(0.0)
    for lang, n in per_lang.items():
        share = F.when(F.col("lang") == lang, min(1.0, quota / n)).otherwise(share)
    order = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 40))
    chosen = labelled.withColumn("order", order).where(F.col("order") < share * float(1 << 40)).orderBy("order", "doc_id").limit(sample)
    rows = chosen.select("lang", "text").mapInArrow(frugal(_shares), "lang string, features binary, shares binary").collect()
    langs = sorted({r["lang"] for r in rows})
    known = {lang: k for k, lang in enumerate(langs)}
    if not langs:
        return Model([], np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    examples = []
    for r in rows:
        at = np.frombuffer(r["features"], "<i4")
        x = np.frombuffer(r["shares"], "<f4").astype(np.float64) * idf[at] * GAIN
        examples.append((np.append(at, FEATURES), np.append(x, 1.0), known[r["lang"]]))
    shuffle = np.random.default_rng(7).permutation(len(examples))
    kept = shuffle[len(examples) // 5 :] if len(examples) >= 50 else shuffle
    held = shuffle[: len(examples) // 5] if len(examples) >= 50 else shuffle
    leader = Leader(len(langs))
    for _ in range(EPOCHS):
        for k in kept:
            leader.learn(*examples[k])
    w = leader.weights()
    scores = np.array([examples[k][1] @ w[examples[k][0]] for k in held])
    temperature = _temperature(scores, np.array([examples[k][2] for k in held]))
    return Model(langs, w[:FEATURES] * idf[:, None] * GAIN, w[FEATURES], temperature)


def _predict(model: Model, keep: list[str], text: str, names: list[str]) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            out = [model.predict(x.decode("utf-8", "replace")) for x in texts(batch.column(text))]
            lang, score = ([r[k] for r in out] for k in range(2))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*keep, *names])

    return run


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``keep`` columns of ``docs`` with those of the dictionary: lang, score."""
    names = unused(docs.columns, "lang", "score")
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    judged = docs.select(*dict.fromkeys([*keep, text])).mapInArrow(frugal(_predict(model, keep, text, list(names.values()))), f"{kinds}`{names['lang']}` string, `{names['score']}` double")
    return judged, names


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row; documents with crc32(doc_id) mod 5 = 0 teach nothing."""
    held_out = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(True))
    model = train(docs.where(~held_out))
    judged, names = identify(docs, model, ["doc_id"])
    return judged.select("doc_id", held_out.alias("held_out"), F.col(names["lang"]).alias("lang_pred"), F.col(names["score"]).alias("score"))
