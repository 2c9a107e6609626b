"""Counts against the tokenizers library, on prose, odd characters and special strings."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyloom.llm import token_counts as tc
from tallyloom.llm.queries import QUERIES, WORD_BPE

LIBRARY = Tokenizer.from_file(WORD_BPE)
COLUMNS = ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def wanted(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_whole_table(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = QUERIES["op8_token_counts"](spark, folder)
    assert df.columns == COLUMNS
    got = {r.doc_id: tuple(r)[1:] for r in df.collect()}
    assert got == {k: (len(t.encode()), wanted(t), wanted(t) > 2048) for k, t in texts.items()}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert tc.count_texts([text], WORD_BPE) == [wanted(text)]


@pytest.mark.parametrize("text", ["aaaaaaa aaaa", "It's we'll I'D 'Ss", "<|endoftext|>a<|startoftext|><|ENDOFTEXT|>", "a\x1cb\x85c\xa0d\u2003e\u180ef", "İstanbul ΣΑΣ ﬁ", "e\u0301 \u0308a", "１２３ ½²", "한글 \u1112\u1161\u11ab"])
def test_odd_texts(text):
    assert tc.count_texts([text], WORD_BPE) == [wanted(text)]


def test_merging_one_place_a_round_gives_the_same():
    merger = tc.Merger(WORD_BPE)
    words = [w.encode() for w in ("aaaaaaaa", "banana", "mississippi", "thethethe", "!!!!!")]
    fast = merger.surviving(words).tolist()
    merger.at_once = False
    assert merger.surviving(words).tolist() == fast


def test_small_store_changes_nothing(monkeypatch):
    texts = ["one two three", "four five", "one six seven eight", "two"]
    monkeypatch.setattr(tc, "HELD", 3)
    assert tc.count_texts(texts, WORD_BPE) == [wanted(t) for t in texts]


def test_every_white_space_parts_words():
    for code in [*range(0x21), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]:
        text = f"é{chr(code)}ж"
        assert tc.count_texts([text], WORD_BPE) == [wanted(text)], hex(code)


def test_awkward_rows(spark, awkward, empty):
    got = tc.token_counts(awkward, WORD_BPE).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == sorted((r.doc_id or 0, len((r[1] or "").encode()), wanted(r[1] or "")) for r in awkward.collect())
    assert tc.token_counts(empty, WORD_BPE).columns == COLUMNS
    assert tc.token_counts(empty, WORD_BPE).count() == 0


def test_vocabulary_is_read_where_it_lies():
    assert WORD_BPE == public_tokenizers.path("word_bpe_49k.json")
