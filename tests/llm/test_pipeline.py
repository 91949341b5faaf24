import numpy as np
import public_tokenizers
import zlib

import corpus_pipeline
from citeflow.llm.token_counts import load_tokenizer
from tests.llm.cases import awkward, empty
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_dedup import brute as duplicates


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_one_by_one(spark, sf, tmp_path):
    """Each stage against a plain version of itself, on what its predecessor kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, every = docs.columns, {r["doc_id"]: tuple(r) for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = _rows(docs)
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == columns
        assert all(tuple(r) == every[r["doc_id"]] for r in docs.collect())
        after = {i for i, _ in _rows(docs)}
        if name == "language_id":
            assert len(after) > 0.97 * len(before)
        elif name == "near_dedup":
            assert after == {r[0] for r in duplicates(before, 5) if r[3]}
        elif name == "decontaminate":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert after == {r[0] for r in contaminated(before, items) if not r[5]}
        else:
            assert 0.2 * len(before) < len(after) <= len(before)
    tokenizer, start, want = load_tokenizer(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for i, text in sorted(_rows(docs)):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect())) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == want


def test_awkward_and_empty(spark, sf):
    for docs in (awkward(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, sf)
            assert kept.columns == docs.columns and kept.count() <= docs.count()


def test_queries_carry_the_oracles_names():
    from citeflow.llm.queries import ORACLE_SQL, QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)
