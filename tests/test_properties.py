import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeflow.functions import text as tx
from citeflow.operators.normalise import normalise, repair_number, repair_word

TEXT = st.text(alphabet="lIOoSsgG0123456789.-–— nºN°o\n\táéçúmrnSúlaRESp/()", max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_every_normalised_character_has_a_place(text):
    norm, at = normalise(text)
    assert len(norm) == len(at)
    assert all(a <= b for a, b in zip(at, at[1:], strict=False))
    assert all(0 <= k < len(text) for k in at)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_repairs_keep_digits_and_lengths(text):
    fixed = repair_number(text)
    assert len(fixed) == len(text)
    assert all(a == b for a, b in zip(text, fixed, strict=True) if a.isdigit())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="mrnabceiou", max_size=12))
def test_unknown_words_change_only_to_known_ones(word):
    fixed = repair_word(word)
    assert fixed == word or repair_word(fixed) == fixed


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aàáâãäåçéêíñóôõúüýÿşžḿệ\u0301\u0303\u0327AÇÉÑzŽ ", max_size=12), min_size=1, max_size=20))
def test_fold_does_to_columns_what_it_does_to_words(spark, words):
    words = words + [unicodedata.normalize("NFD", w) for w in words]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(tx.fold(F.col("w"))).collect()
    assert [r[0] for r in got] == [tx.folded(w) for w in words]
    assert all(tx.folded(w) == tx.folded(unicodedata.normalize("NFC", w)) for w in words)
