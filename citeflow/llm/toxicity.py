"""Toxicity of texts whose words may be disguised: restored by a noisy channel, then scored by a logistic regression.

The characters' language model counts the words of all documents. Features are whole words and beginnings of words of three
to six letters; the most telling ones by likelihood ratio, over all labelled training rows, are kept. The regression's
weights come from a bounded sample of labelled training rows (``SAMPLE``), which a hash of the id picks.

Defined results. A null text counts as empty; a text without known features gets the score of the intercept and its length.
Ids repeat as the rows do; a null id is not held out and has no label. Of several labels of an id the largest counts, null
labels are none. Without labels of both kinds every score is the smoothed share of label 1. Further columns are left out.
Texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import slices, texts, unused, written
from citeflow.llm.deobfuscate import EDGE, ORDER, Model, Restorer, marked

#: Labelled rows of the regression, at most about; features; grams of each length of the language model.
SAMPLE, FEATURES, GRAMS = 32_768, 2_048, 65_536
#: Lengths of beginnings; a feature is in so many texts of label 1 at least.
BEGINNINGS, LEAST = (3, 4, 5, 6), 5
#: Rows of labels up to which they are sent to the documents, instead of shuffling these.
SENT_LABELS = 2_000_000
STEPS, PENALTY = 1500, 2e-5
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")


def _bucket() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 3


def character_model(documents: DataFrame, grams: int = GRAMS) -> Model:
    """Counts of the most frequent runs of characters in the words of all documents."""
    words = documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word")).groupBy("word").count()
    edged = words.select(F.concat(F.lit(EDGE), "word", F.lit(EDGE)).alias("w"), "count")
    runs = f"flatten(transform(sequence(2, length(w)), i -> transform(sequence(1, least({ORDER}, i)), k -> substring(w, i - k + 1, k))))"
    counts = edged.select(F.explode(F.expr(runs)).alias("gram"), "count").groupBy("gram").agg(F.sum("count").alias("n"))
    kept = written(counts.withColumn("k", F.length("gram")), "toxicity-grams")
    found = []
    for k in range(1, ORDER + 1):
        found += kept.where(F.col("k") == k).orderBy(F.desc("n"), "gram").limit(grams).select("gram", "n").collect()
    return Model((r.gram, r.n) for r in found)


def training_texts(documents: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """toxic, share (a hash of the id, from 0 to 1), text (restored) of the labelled rows that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(_bucket() != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = written(known, "toxicity-labels")
    if known.count() <= SENT_LABELS:
        known = F.broadcast(known)
    n = unused(documents.columns, "id")["id"]
    share = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string")), 1) / F.lit(2.0**63)
    rows = documents.select("doc_id", "text").join(known.withColumnRenamed("doc_id", n), F.col("doc_id") == F.col(n)).select(F.col("toxic").cast("int").alias("toxic"), share.alias("share"), "text")

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for piece in slices(batches, 256):
            found = pa.array([restorer.restored(t.decode()) for t in texts(piece.column(2))], pa.string())
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), found], ["toxic", "share", "text"])

    return written(rows.mapInArrow(restored, "toxic int, share double, text string"), "toxicity-training")


def telling_features(training: DataFrame, most: int = FEATURES) -> list[str]:
    """The features with the largest likelihood ratios among those commoner in texts of label 1; a word counts once a text."""
    words = training.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\p{L}+"), 0))).alias("word"))
    ones = F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))
    counted = written(words.groupBy("word").agg(F.count("*").alias("n"), ones.alias("a")), "toxicity-words")
    total, toxic = counted.agg(F.sum("n"), F.sum("a")).head()
    if not toxic or toxic == total:
        return []
    begun = F.array(*(F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("-"))) for k in BEGINNINGS))
    each = counted.select(F.explode(F.array_append(F.filter(begun, lambda x: x.isNotNull()), F.col("word"))).alias("feature"), "n", "a")
    sums = each.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("a").alias("a")).where(F.col("a") >= LEAST).where(F.col("a") * F.lit(float(total)) > F.col("n") * F.lit(float(toxic)))

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, a, p = F.col("n"), F.col("a"), toxic / total
    ratio = term(a, n * p) + term(n - a, n * (1 - p)) + term(toxic - a, (total - n) * p) + term(total - n - toxic + a, (total - n) * (1 - p))
    return [r.feature for r in sums.orderBy(ratio.desc(), "feature").limit(most).select("feature").collect()]


class Features:
    """Numbers and values of the known features of texts, by tokens whose features are remembered up to a bound."""

    def __init__(self, model: Model, known: dict[str, int]) -> None:
        self.restorer, self.known = Restorer(model), known
        self.found: dict[str, tuple[int, ...]] = {}
        self.starts = {name[: BEGINNINGS[0]] for name in known}

    def of_token(self, token: str) -> tuple[int, ...]:
        """The token's features; -1 before them if it was restored."""
        restored = self.restorer.token(token) if marked(token) else token
        out = [-1] if restored != token else []
        for word in _WORD.findall(restored):
            if word[: BEGINNINGS[0]] in self.starts:
                names = [word, *(word[:size] + "-" for size in BEGINNINGS if len(word) > size)]
                out += [self.known[x] for x in names if x in self.known]
        return tuple(out)

    def of(self, text: str) -> tuple[list[int], list[float], int]:
        """Features, their values (log of one and the count; the last is the length), and how many tokens were restored."""
        found: Counter[int] = Counter()
        total = changed = 0
        for tokens in self.restorer.tokens(text):
            total += len(tokens)
            for token, n in Counter(tokens).items():
                ids = self.found.get(token)
                if ids is None:
                    ids = self.of_token(token)
                    if len(self.found) < self.restorer.most:
                        self.found[token] = ids
                for k in ids:
                    found[k] += n
        changed = found.pop(-1, 0)
        ids = sorted(found)
        return [*ids, len(self.known)], [*(float(np.log1p(found[k])) for k in ids), float(np.log1p(total)) / 10], changed


def fitted(training: DataFrame, model: Model, known: dict[str, int], sample: int = SAMPLE) -> np.ndarray:
    """Weights by feature, of the length and the intercept, from about ``sample`` training rows at most."""
    rows = training.count()

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model, known)
        for piece in slices(batches, 256):
            found = [features.of(t.decode()) for t in texts(piece.column(1))]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([k for k, _, _ in found], pa.list_(pa.int32())), pa.array([v for _, v, _ in found], pa.list_(pa.float64()))], ["toxic", "k", "v"])

    picked = training.where(F.col("share") <= sample / max(rows, 1)).select("toxic", "text").mapInArrow(values, "toxic int, k array<int>, v array<double>").toArrow()
    y = picked.column("toxic").to_numpy().astype(float).clip(0, 1)
    order = np.argsort(y, kind="stable")
    ids, shown = picked.column("k").combine_chunks(), picked.column("v").combine_chunks()
    row = np.repeat(np.arange(len(y)), ids.value_lengths().to_numpy())
    column, value = ids.flatten().to_numpy(), shown.flatten().to_numpy()
    weights = np.zeros(len(known) + 2)
    weights[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    if not len(order) or y.min() == y.max():
        return weights
    # Nesterov's gradient steps; a step's length from the largest row.
    squares = np.bincount(row, value * value, len(y)) + 1
    step, ahead, old = 4 / np.mean(squares), weights.copy(), weights.copy()
    decay = np.full(len(weights), PENALTY)
    decay[-1] = 0
    for t in range(STEPS):
        margin = np.bincount(row, value * ahead[column], len(y)) + ahead[-1]
        miss = 1 / (1 + np.exp(-margin)) - y
        gradient = np.bincount(column, value * miss[row], len(weights)) / len(y) + decay * ahead
        gradient[-1] += miss.mean()
        weights = ahead - step * gradient
        ahead = weights + t / (t + 3) * (weights - old)
        old = weights
    return weights


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_restored (disguised tokens that were replaced) for each document."""
    model = character_model(documents)
    training = training_texts(documents, labels, model)
    known = {f: k for k, f in enumerate(telling_features(training))}
    weights = fitted(training, model, known)
    rows = documents.select("doc_id", _bucket().alias("bucket"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model, known)
        for piece in slices(batches, 256):
            scores, changed = [], []
            for t in texts(piece.column(2)):
                ids, values, n = features.of(t.decode())
                margin = float(np.dot(weights[ids], values)) + weights[-1]
                scores.append(1 / (1 + np.exp(-min(max(margin, -500.0), 500.0))))
                changed.append(n)
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(scores, pa.float64()), pa.array(changed, pa.int64())], ["doc_id", "bucket", "score", "n_restored"])

    out = rows.mapInArrow(scored, f"doc_id {kind}, bucket bigint, score double, n_restored bigint")
    return out.select("doc_id", (F.col("bucket") == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_restored")
