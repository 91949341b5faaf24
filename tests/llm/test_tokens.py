import zlib

import numpy as np
import public_tokenizers
import pytest
from tests.llm.cases import awkward, empty

from citeflow.llm import common, queries, token_counts, token_output
from citeflow.llm.token_counts import load_tokenizer

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def _texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["table", "awkward"])
def test_counts_equal_the_library(spark, sf, which):
    docs = spark.read.parquet(f"{sf}/documents.parquet") if which == "table" else awkward(spark)
    got = queries.op2_token_counts(spark, sf) if which == "table" else token_counts.token_counts(docs, BYTE)
    tokenizer = load_tokenizer(BYTE)
    want = sorted(((i, len(t.encode()), n := len(tokenizer.encode(t, add_special_tokens=False).ids), n > 1024) for i, t in _texts(docs)), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_proven_strings_are_single_tokens():
    tokenizer = load_tokenizer(BYTE)
    whole = token_counts.proven_whole(tokenizer)
    assert len(whole) > 40_000
    assert all(len(tokenizer.encode(s).ids) == 1 for s in list(whole)[::97])


def test_small_cache_changes_nothing():
    small, text = token_counts.Counter(BYTE, limit=2), "zqxv blorf zqxv\n\nqqq   wwww 'ssss <|endoftext|>x ͸ࢗ5a"
    assert small.count(text * 3) == len(small.tokenizer.encode(text * 3, add_special_tokens=False).ids)


@pytest.mark.parametrize("which", ["table", "awkward"])
def test_output_round_trip(spark, sf, which, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet") if which == "table" else awkward(spark)
    got = [tuple(r) for r in token_output.token_output(docs, WORD, str(tmp_path / "shards")).collect()]
    tokenizer, want, start = load_tokenizer(WORD), [], 0
    for number, text in sorted(_texts(docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((number, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_narrow_texts_are_split_and_kept_as_bytes():
    """Every pair of code points up to U+00FF, and words with them, by the library's ids; with a table that overflows too."""
    encoder = token_output.Encoder(WORD, limit=50)
    narrow = [chr(c) for c in range(256)]
    whole = "".join(f"{a}{b} X{a}y{b}Z'S" for a in narrow[::3] for b in narrow)
    for text in (whole, "Ünïcode ÀÉÞ× ªµº ß'LL don't ½¾ 12 \x85\xa0\x1c+++", "<|ENDOFTEXT|> a", "ź wide", ""):
        assert np.frombuffer(encoder.encode(text.encode()), "<u2").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder and all(type(piece) is bytes for piece in encoder)


def test_texts_of_a_block_share_their_look_ups():
    """A pre-token that many texts of a block hold is looked up once, and texts keep their borders and their order."""
    encoder, asked = token_output.Encoder(WORD, limit=3), []
    plain = encoder.merged
    encoder.merged = lambda pieces: asked.extend(pieces) or plain(pieces)
    texts = ["zqxv'", "s don't", "", "zqxv ź", "don't zqxv", " \x85 ", "x <|endoftext|> zqxv", "12", "3 É+'LL'", "'re'", "'"] * 50
    got = encoder.encode_all([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) == len(set(asked)) and {b"zqxv", b"don", b"'t"} <= set(asked)
    assert len(encoder) == 6 and encoder.encode_all([]) == []


def test_random_access_by_expansion_lengths():
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 500, 40)
    docs = [np.concatenate([np.tile(phrase, rng.integers(1, 60)), rng.integers(0, 500, rng.integers(0, 30)), [2]]) for _ in range(30)]
    n_ids = np.array([len(d) for d in docs])
    blob = token_output.pack(list(range(30)), np.concatenate(docs), n_ids, 49408)
    shard = token_output.Shard(blob)
    assert len(shard.left) > 10 and len(shard.symbols) < n_ids.sum() / 3
    for k, d in enumerate(docs):
        assert (shard.ids(k) == d).all()
        assert [shard.token(k, i) for i in range(len(d))] == d.tolist()


def test_overlapping_pairs_of_one_symbol():
    ids = np.array([7] * 101 + [2] + [7] * 50 + [2], dtype=np.int64)
    shard = token_output.Shard(token_output.pack([1, 2], ids, np.array([102, 51]), 49408))
    assert shard.ids(0).tolist() == ids[:102].tolist() and shard.ids(1).tolist() == ids[102:].tolist()


def test_empty_tables(spark, tmp_path):
    assert token_counts.token_counts(empty(spark), BYTE).count() == 0
    assert token_output.token_output(empty(spark), WORD, str(tmp_path / "none")).count() == 0


def test_encoder_goes_when_another_operator_begins(monkeypatch):
    """A worker process keeps the encoder for the tasks of its own kind only, and gives memory back after each task."""
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    encoder = token_output._encoder(WORD)
    list(common.frugal(iter, token_output._name(WORD))([]))
    assert token_output._encoder(WORD) is encoder and len(given) == 1
    list(common.frugal(iter)([]))
    assert not common._KEPT and len(given) == 2
    assert token_output._encoder(WORD) is not encoder


def test_offsets_of_shards_need_no_python_rows(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    token_output.write_token_shards(docs, WORD, str(tmp_path / "shards"))
    shards = token_output.read_token_shards(spark, str(tmp_path / "shards"))
    assert "ExistingRDD" not in shards._jdf.queryExecution().executedPlan().toString()
    rows = sorted(shards.select("part", "part_start", "n_ids", "start").collect())
    assert [r["start"] for r in rows] == [sum(x["n_ids"] for x in rows[:k]) for k in range(len(rows))]
