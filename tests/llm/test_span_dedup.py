import random

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import awkward, empty

from citeflow.llm import queries, span_dedup

ENOUGH, EDGE = span_dedup.ENOUGH_WORDS, span_dedup.WINDOW - 1


def _words(text):
    """(word, start, end) by hand, character by character."""
    out, at = [], None
    for k, c in enumerate(text + " "):
        if c in " \t\n\r\f\v":
            if at is not None:
                out.append(("".join(x.lower() if x.isascii() else x for x in text[at:k]), at, k))
                at = None
        elif at is None:
            at = k
    return out


def _sentence_spans(text, words, sentences, least):
    """(first word, word after the last) of so many sentences in a row, so many words at least, by hand."""
    ends, at = [], 0
    for k, (_, a, b) in enumerate(words):
        between = text[b : words[k + 1][1]] if k + 1 < len(words) else "\n"
        if text[b - 1] in ".!?" or "\n" in between or "\r" in between:
            if k + 1 - at >= 4:
                ends.append(k + 1)
                at = k + 1
    if ends and at < len(words):
        ends[-1] = len(words)
    out = []
    for i, start in enumerate([0, *ends[:-1]] if ends else []):
        for end in ends[i + sentences - 1 :]:
            if end - start >= least:
                out.append((start, end))
                break
    return out


def judged(rows, found, sentences=span_dedup.SENTENCES, least=span_dedup.SPAN_WORDS):
    """By plain comparison of words: words that may go and words that must, against what went."""
    rows = sorted((n, t or "") for n, t in rows if n is not None)
    seen, wrong, missed = {}, [], []
    for number, text in rows:
        words = _words(text)
        own = [w for w, _, _ in words]
        may, must = set(), set()
        runs = [tuple(own[k : k + ENOUGH]) for k in range(len(own) - ENOUGH + 1)]
        earlier = [r in seen and (seen[r] < number) or r in runs[:k] for k, r in enumerate(runs)]
        k = 0
        while k < len(runs):
            if earlier[k]:
                end = k
                while end < len(runs) and earlier[end]:
                    end += 1
                may.update(range(k, end + ENOUGH - 1))
                must.update(range(k + EDGE, end + ENOUGH - 1 - EDGE) if end - k > 2 * EDGE else ())
                k = end
            else:
                k += 1
        spans = [(a, b, tuple(own[a:b])) for a, b in _sentence_spans(text, words, sentences, least)]
        for k, (a, b, span) in enumerate(spans):
            if seen.get(span, number) < number or span in [s for _, _, s in spans[:k]]:
                may.update(range(a, b))
                must.update(range(a, b))
        gone = {k for k, (_, a, b) in enumerate(words) if any(x <= a and b <= y for n, x, y in found if n == number)}
        if not gone <= may:
            wrong.append(number)
        if not must <= gone:
            missed.append(number)
        for r in [*runs, *(s for _, _, s in spans)]:
            seen.setdefault(r, number)
    return wrong, missed


def _found(df):
    return {(r["doc_id"], r["start"], r["end"]) for r in df.collect()}


def test_table_against_plain_comparison_of_words(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = _found(queries.op7_span_dedup(spark, sf))
    assert found and judged(rows, found, 2, 50) == ([], [])
    short = _found(span_dedup.repeated_spans(spark.read.parquet(f"{sf}/documents.parquet")))
    assert {n for n, _, _ in found} <= {n for n, _, _ in short} and judged(rows, short) == ([], [])


def test_query_returns_short_passages_too(spark, sf, tmp_path):
    """Whole passages are those of the operator's own rule; the parts of fifty words are as they were."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = queries.op7_span_dedup(spark, sf)
    whole = _found(found.selectExpr("doc_id", "passage_start AS start", "passage_end AS end"))
    assert judged(rows, whole) == ([], []) and whole == _found(span_dedup.repeated_spans(docs))
    parts = found.where("start < end")
    columns = ["doc_id", "start", "end", "n_spans", "first_doc_id"]
    long = span_dedup.repeated_spans(docs, sentences=2, span_words=50)
    assert sorted(parts.select(*columns).collect()) == sorted(long.select(*columns).collect())
    assert parts.where("start < passage_start OR end > passage_end").count() == 0
    shared = "The cat sat down. A dog ran very far. The end came at last."
    spark.createDataFrame([(1, f"{shared} Epsilon zeta eta theta."), (2, f"Four more words here. {shared}")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    (short,) = queries.op7_span_dedup(spark, str(tmp_path)).collect()
    assert (short["doc_id"], short["passage_start"], short["passage_end"], short["passage_first_doc_id"], short["n_spans"]) == (2, 22, 22 + len(shared), 1, 0) and short["start"] == short["end"]


def test_passages_are_cut_and_clean_documents_left(spark):
    rng = random.Random(9)

    def prose(n):
        return " ".join(" ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(5, 15))).capitalize() + "." for _ in range(n))

    passage = prose(9)
    clean = {k: prose(20) for k in range(30)}
    rows = [(k, t) for k, t in clean.items()] + [(100 + k, f"{prose(3)} {passage}\n{prose(3)}") for k in range(10)]
    rows += [(200, "ONE! TWO! ONE! TWO! " * 3), (201, passage + " " + passage)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, start string")
    found = _found(span_dedup.repeated_spans(docs))
    assert judged(rows, found) == ([], [])
    assert {d for d, _, _ in found} == {*range(101, 110), 201}
    out = {r["doc_id"]: r["text"] for r in span_dedup.drop_repeated_spans(docs).collect()}
    assert all(out[k] == t for k, t in clean.items()) and passage in out[100]
    assert out[200] == dict(rows)[200]
    assert all(len(out[100 + k].split()) < len(dict(rows)[100 + k].split()) - ENOUGH for k in range(1, 10))


def test_unaligned_passages_go_but_for_their_edges(spark):
    rng = random.Random(4)

    def fresh(n):
        return [f"x{rng.randrange(10**9)}" for _ in range(n)]

    inside, short = " ".join(fresh(90)), " ".join(fresh(45))
    rows = [(k, " ".join([*fresh(7), (inside, short)[k % 2], *fresh(9)])) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = _found(span_dedup.repeated_spans(docs))
    assert judged(rows, found) == ([], []) and {n for n, _, _ in found} == {2, 4, 6}


def test_passages_of_just_over_fifty_words_go_whole(spark):
    """Of all lengths from 50 words on, inside sentences, and where one holder has another passage next to it."""
    rng = random.Random(5)

    def fresh(n):
        return [f"y{rng.randrange(10**9)}" for _ in range(n)]

    rows, want = [], set()
    for n in range(46, 64):
        passage, lead = fresh(n), fresh(3 + n % 7)
        rows += [(n, " ".join([*fresh(11), *passage, *fresh(8)])), (100 + n, " ".join([*lead, *passage, *fresh(8)]))]
        if n >= 50:
            at = len(" ".join(lead)) + 1
            want.add((100 + n, at, at + len(" ".join(passage))))
    ab = "a b " * 30
    rows += [(300, ab.strip()), (301, " ".join(fresh(60)))]
    want.add((300, 4, len(ab) - 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _found(span_dedup.repeated_spans(docs, sentences=2, span_words=50)) == want
    assert _found(span_dedup.repeated_spans(docs)) == want


def test_three_short_sentences_are_enough(spark):
    shared = "The cat sat down. A dog ran very far. The end came at last."
    rows = [(1, f"Alpha beta gamma delta. {shared} Epsilon zeta eta theta."), (2, f"One two three four. {shared} Five six seven eight."), (3, "Two only here now. The cat sat down. A dog ran very far. Not the same end.")]
    found = _found(span_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert judged(rows, found) == ([], [])
    at = rows[1][1].index(shared)
    assert found == {(2, at, at + len(shared))}


def test_shares_of_short_and_long_passages(spark):
    """Nineteen in twenty planted words go at least, of passages of three sentences and of long ones without borders; none of clean documents."""
    rng = random.Random(12)

    def sentence(n):
        return " ".join(f"v{rng.randrange(10**8)}" for _ in range(n)) + "."

    short, long = [" ".join(sentence(6) for _ in range(3)) for _ in range(20)], [sentence(80)[:-1] for _ in range(20)]
    rows, planted = [], []
    for k in range(200):
        passage = (short, long)[k % 2][k // 2 % 20]
        lead = " ".join(sentence(8) for _ in range(4))
        rows.append((k, f"{lead} {passage} {sentence(7)}"))
        planted.append((k, len(lead) + 1, len(lead) + 1 + len(passage)))
    rows += [(1000 + k, " ".join(sentence(9) for _ in range(12))) for k in range(100)]
    found = _found(span_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")))
    for kind in (0, 1):
        later = [(k, a, b) for k, a, b in planted if k % 2 == kind and k >= 40]
        gone = sum(max(0, min(b, y) - max(a, x)) for k, a, b in later for n, x, y in found if n == k)
        assert gone >= (0.95 if kind == 0 else 0.8) * sum(b - a for _, a, b in later)
        assert all(any(n == k for n, _, _ in found) for k, _, _ in later)
    assert not any(n >= 1000 or n < 40 for n, _, _ in found)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = _found(span_dedup.repeated_spans(docs))
    assert {n for n, _, _ in found} == {6, 7}
    out = span_dedup.drop_repeated_spans(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert span_dedup.repeated_spans(empty(spark)).count() == 0
    clash = docs.selectExpr("*", "1 AS __gone", "doc_id AS __holder")
    assert span_dedup.drop_repeated_spans(clash).columns == clash.columns
    assert len(rows) == out.count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B.", "c!", "é?", "d\n", "  ", "\t", "Ü", "\r\n"]), max_size=200))
def test_places_and_hashes_are_those_of_the_words(parts):
    text = " ".join(parts)
    words = _words(text)
    hashes, starts, ends = span_dedup.spans(text.encode())
    by_hash = {}
    for h, a, b in zip(hashes.tolist(), starts.tolist(), ends.tolist()):
        own = tuple(w for w, x, y in words if a <= x and y <= b)
        assert len(own) >= span_dedup.SPAN_WORDS and by_hash.setdefault(h, own) == own
    assert len({*by_hash.values()}) == len(by_hash)


def test_long_texts_are_hashed_in_pieces_alike(monkeypatch):
    text = ("Some words, and more of them here. " * 40 + "\n").encode()
    whole = [x.tolist() for x in span_dedup.spans(text)]
    monkeypatch.setattr(span_dedup, "PIECE_BYTES", 64)
    assert [x.tolist() for x in span_dedup.spans(text)] == whole


def test_sentences():
    ends = span_dedup.Words(b"A b c d. E! F? g h i j\nk l m n o. p").sentence_ends()
    assert ends.tolist() == [4, 10, 16]
