from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexigrove.llm.encode import TOKENIZERS, WORDS, Lexicon, encode, encode_texts, encoder, frequent_words, word_memo
from lexigrove.llm.flat import FlatMemo
from lexigrove.llm.transducer import Transducer

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary files")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abcé日", max_size=6), max_size=60), st.lists(st.text(alphabet="abcdé日", max_size=7), max_size=30))
def test_transducer(words, others):
    ordered = sorted(w.encode() for w in words)
    t = Transducer.build(ordered)
    asked = ordered + [w.encode() for w in others]
    assert t.ranks(asked).tolist() == [ordered.index(w) if w in ordered else -1 for w in asked]


def test_transducer_shares_suffixes():
    words = sorted((a + b).encode() for a in ("re", "un", "over") for b in ("making", "taking", "baking"))
    t = Transducer.build(words)
    assert len(t.final) < 25 and t.ranks(words).tolist() == list(range(9))


def memo_for(tmp_path, words):
    enc = encoder(VOCABULARY)
    path = str(tmp_path / "lexicon.bin")
    with open(path, "wb") as file:
        file.write(Lexicon.compile(words, enc.encode_ordinary))
    return word_memo(Lexicon(path), enc.encode_ordinary)


def test_exact_on_odd_texts(tmp_path, reference):
    random.seed(3)
    alphabet = " \t\n\r\x85\xa0  \x1c\x1f　​'sdtll.-,!é日ß1２3aŹ\U0001f600<|endoftext|>"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(3_000)] + ["<|endoftext|>", "", None, "x" * 50_000, " " * 20_000, "don't  we'll\n\n they've "]
    for words in ([], [w for t in texts[:500] if t for w in WORDS.findall(t)]):
        memo = memo_for(tmp_path, words)
        assert encode_texts(memo, texts).to_pylist() == reference(texts)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_words_cover_the_text(text):
    assert "".join(WORDS.findall(text)) == text


def test_memo_starts_anew_when_full(monkeypatch):
    from lexigrove.llm import flat

    monkeypatch.setattr(flat, "MEMO_PIECES", 5)
    memo = FlatMemo(lambda pieces: [[len(p)] * 2 for p in pieces])
    for texts in ([["a", "bb"], []], [[f"x{i}" for i in range(9)]], [["a", "ccc"]]):
        flat_, bounds = memo.numbers(texts)
        assert [flat_[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [[n for p in t for n in [len(p)] * 2] for t in texts]


def test_documents(spark, data, reference):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], reference([r.text for r in rows]), strict=True))
    for n in (32_768, 50, 0):
        got = {r.doc_id: list(r.ids) for r in encode(docs, lexicon_words=n).collect()}
        assert got == want


def test_nulls_repeats_clashes_and_empty(spark):
    df = spark.createDataFrame([(1, None, 5, "w"), (2, "", 5, "w"), (3, "a b", 5, "w"), (3, "a b", 5, "w"), (None, " ", 5, "w")], "doc_id bigint, text string, ids int, word string")
    got = sorted(((r.doc_id, list(r.ids)) for r in encode(df).collect()), key=repr)
    assert got == sorted([(1, []), (2, []), (3, [64, 275]), (3, [64, 275]), (None, [220])], key=repr)
    assert encode(df.where("false")).collect() == []
    assert dict(encode(df).dtypes) == {"doc_id": "bigint", "ids": "array<int>"}


def test_frequent_words_break_ties_by_word(spark):
    df = spark.createDataFrame([("b a c",), ("x b a c",), (None,)], "text string")
    assert frequent_words(df, limit=2) == [" a", " c"]


def test_same_lexicon_is_kept_once(spark):
    rows = spark.createDataFrame([(1, "the same words, the same lexicon")], "doc_id bigint, text string")
    once = [r.ids for r in encode(rows).collect()]
    before = len(spark.sparkContext.listFiles)
    assert [r.ids for r in encode(rows).collect()] == once and len(spark.sparkContext.listFiles) == before
