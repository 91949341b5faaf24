import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from citeflow.llm.decontaminate import Block, Shard
from citeflow.llm.token_output import Encoder, pack
from citeflow.llm.token_output import Shard as TokenShard

IDS = st.lists(st.lists(st.integers(0, 6), max_size=80), min_size=1, max_size=6)
ENCODER = Encoder(public_tokenizers.path("word_bpe_49k.json"), limit=3)


@settings(max_examples=150, deadline=None)
@given(IDS)
def test_shards_give_back_their_ids(docs):
    docs = [[*d, 2] for d in docs] * 4
    shard = TokenShard(pack(list(range(len(docs))), np.concatenate([np.array(d) for d in docs]), np.array([len(d) for d in docs]), 10))
    assert [shard.ids(k).tolist() for k in range(len(docs))] == docs
    assert shard.all_ids().tolist() == [x for d in docs for x in d]
    assert [shard.token(0, i) for i in range(len(docs[0]))] == docs[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=9), min_size=1, max_size=4))
def test_suffix_search_finds_longest_matches_and_windows(doc, items):
    block = Block([(str(k), b" ".join(b"w%d" % x for x in item)) for k, item in enumerate(items)], window=4)
    ids = np.array([block.vocabulary.get(b"w%d" % x, 0) for x in doc], dtype=np.int32)
    shard = Shard(ids, 1)
    suffixes = [shard.words[k : k + shard.left[k]].tolist() for k in shard.array]
    assert suffixes == sorted(suffixes) and len(suffixes) == (ids > 0).sum()
    longest, first, low, high = shard.search(block)
    plain = ids.tolist()
    for k in range(len(block.words)):
        own = block.words[k : k + block.left[k]].tolist()
        held = [max((n for n in range(len(own) + 1) if plain[p : p + n] == own[:n]), default=0) for p in range(len(plain))]
        assert longest[k] == max(held, default=0)
        if longest[k]:
            p = int(shard.place[first[k]])
            assert plain[p : p + int(longest[k])] == own[: int(longest[k])]
        if n := int(block.window[k]):
            want = {p for p in range(len(plain) - n + 1) if plain[p : p + n] == own[:n]}
            assert {int(shard.place[p]) for p in shard.array[low[k] : high[k]]} == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBé'st ÀÿÜ12²½ªµ×÷·!?.,\xa0\x85\x1c\x00\n<|>", max_size=60), st.sampled_from(["", "<|endoftext|>", "ź", "e\u0301", "<|EndOfText|>"]))
def test_own_pre_tokens_are_those_of_the_library(text, odd):
    for x in (text, text + odd + text, "don't WE'LL " + text):
        assert np.frombuffer(ENCODER.encode(x.encode()), "<u2").tolist() == ENCODER.tokenizer.encode(x, add_special_tokens=False).ids
