import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import awkward, empty

from citeflow.llm import langid, queries


def test_held_out_accuracy(spark):
    got = queries.op8_langid(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and len(held) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    confident = [r for r in held if r["score"] > 0.9]
    assert len(confident) > 0.8 * len(held) and sum(r["lang_pred"] == r["lang"] for r in confident) / len(confident) > 0.97


def test_awkward_rows(spark):
    out = {r["doc_id"]: r for r in langid.languages(awkward(spark)).collect()}
    assert (out[1]["lang_pred"], out[1]["score"]) == ("und", 0.0) == (out[2]["lang_pred"], out[2]["score"]) == (out[3]["lang_pred"], out[3]["score"])
    assert out[7]["lang_pred"] in ("en", "de") and 0 <= out[7]["score"] <= 1
    assert langid.languages(empty(spark)).count() == 0
    unlabelled = awkward(spark).withColumn("lang", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.languages(unlabelled).collect()} == {"und"}


def test_predictions_do_not_see_the_label(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs)
    a = {tuple(r) for r in langid.identify(docs, model, ["doc_id"])[0].collect()}
    b = {tuple(r) for r in langid.identify(docs.drop("lang", "source"), model, ["doc_id"])[0].collect()}
    assert a == b


def _plain_ngrams(text):
    """Features of a text, character by character: letters kept, runs of anything else one space, spaces around."""
    out, last = [32], True
    for c in text.lower():
        code = ord(c)
        space = not c.isalpha() if code < 0x250 else 0x2000 <= code < 0x2070
        if not (space and last):
            out.append(32 if space else code)
        last = space
    codes, m = [*out, 32], 2**32
    mixed = []
    one = [(c + 1) * 2654435761 % m for c in codes]
    two = [((a ^ (a >> 15)) * 2246822519 + b) % m for a, b in zip(one, one[1:], strict=False)]
    three = [((a ^ (a >> 13)) * 3266489917 + b) % m for a, b in zip(two, one[2:], strict=False)]
    for h in one + two + three:
        mixed.append((h ^ (h >> 16)) * 668265263 % m >> (32 - langid.FEATURES.bit_length() + 1))
    return mixed


def _plain_scores(rows, texts):
    """Language and score by dictionaries and loops: shares times idf, the leader one coordinate at a time, temperature by trying."""
    grams = [Counter(_plain_ngrams(t)) for t, _ in rows]
    df = Counter(f for g in grams for f in g)
    idf = lambda f: math.log((1 + len(rows)) / (1 + df[f])) + 1
    langs = sorted({lang for _, lang in rows})

    def values(g):
        return {f: n / sum(g.values()) * idf(f) * langid.GAIN for f, n in g.items()} | {-1: 1.0}

    z, n = defaultdict(float), defaultdict(float)

    def weight(f, k):
        v = z[f, k]
        return 0.0 if abs(v) <= langid.L1 else -(v - math.copysign(langid.L1, v)) / ((langid.BETA + math.sqrt(n[f, k])) / langid.ALPHA + langid.L2)

    def margins(x):
        return [sum(v * weight(f, k) for f, v in x.items()) for k in range(len(langs))]

    def soft(s):
        e = [math.exp(v - max(s)) for v in s]
        return [v / sum(e) for v in e]

    order = np.random.default_rng(7).permutation(len(rows))
    held, kept = order[: len(rows) // 5], order[len(rows) // 5 :]
    for _ in range(langid.EPOCHS):
        for i in kept:
            x = values(grams[i])
            p = soft(margins(x))
            p[langs.index(rows[i][1])] -= 1
            now = {(f, k): weight(f, k) for f in x for k in range(len(langs))}
            for (f, k), w in now.items():
                g = x[f] * p[k]
                z[f, k] += g - (math.sqrt(n[f, k] + g * g) - math.sqrt(n[f, k])) / langid.ALPHA * w
                n[f, k] += g * g
    scored = [(margins(values(grams[i])), langs.index(rows[i][1])) for i in held]
    loss = lambda t: -sum(math.log(soft([v / math.exp(t) for v in s])[k] + 1e-300) for s, k in scored) / len(scored)
    best = min((k / 100 for k in range(-500, 501)), key=loss)
    out = []
    for t in texts:
        p = soft([v / math.exp(best) for v in margins(values(Counter(_plain_ngrams(t))))])
        out.append((langs[p.index(max(p))], max(p)))
    return out, best


def test_equals_plain_dictionaries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL AND length(text) BETWEEN 40 AND 600").orderBy("doc_id").limit(60)
    order = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 40))
    rows = [(r["text"], r["lang"]) for r in docs.orderBy(order, "doc_id").collect()]
    assert len(rows) == 60 and all(sorted(_plain_ngrams(t)) == sorted(langid.ngrams(t).tolist()) for t, _ in rows)
    model = langid.train(docs)
    want, best = _plain_scores(rows, [t for t, _ in rows])
    got = [model.predict(t) for t, _ in rows]
    assert abs(math.log(model.temperature) - best) < 0.02 or abs(best) == 5
    assert [g[0] for g in got] == [w[0] for w in want]
    assert max(abs(g[1] - w[1]) for g, w in zip(got, want, strict=True)) < 0.02


def test_examples_leave_in_small_batches():
    import pyarrow as pa

    sample = pa.table({"lang": [str(k % 3) for k in range(1000)], "text": [f"text {k}" if k % 4 else "7" for k in range(1000)]})
    got = list(langid._shares(iter(sample.to_batches())))
    assert max(b.num_rows for b in got) <= 256
    assert [x for b in got for x in b.column("lang").to_pylist()] == [str(k % 3) for k in range(1000) if k % 4]
