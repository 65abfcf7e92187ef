import hashlib

import public_tokenizers
import pytest
from conftest import DATA, rows
from llm_data import frame  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemodels.llm import bpe as B

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), B.WordBpe(B.vocabulary(PATH))


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    n, joined, decoded = OWN.digest(text)
    assert (n, joined) == (len(ids), " ".join(map(str, ids)))
    assert decoded == OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", "Hello  WORLD it's 123!", "ΑΣ ΣΑΣ İstanbul", "<|endoftext|> a<|startoftext|>b<|END", "café café​　x", "aaaaaaaaaaaaaaa",
     "\x1c a\x1db \x85 x", "don'T 'S ''s", "½²x٣", "日本語 テスト 👩‍👩‍👧", "a" * 3000],
)
def test_like_the_library(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcdehinorst '", max_size=60))
def test_like_the_library_on_letters(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(sorted(OWN._text.values())), max_size=5))
def test_like_the_library_on_joined_tokens(pieces):
    same(bytes(ord(c) & 255 for c in "".join(pieces)).decode("utf-8", "ignore"))


def test_like_the_library_on_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    for r in B.op7_bpe(spark, DATA).collect():
        ids = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        plain = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()


def test_rows_that_are_odd(frame):
    df = frame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b")], ["ids", "N_tokens"])
    got = B.encoded(df, B.vocabulary(PATH)).drop("N_tokens")
    assert rows(got.select("doc_id", "ids")) == rows(frame([]).sparkSession.createDataFrame(
        [(None, [320, 321]), (1, []), (2, []), (3, [320, 321]), (3, [320, 321])], "doc_id long, ids array<int>"))
    assert rows(B.decoded(got.select("ids"), B.vocabulary(PATH)).select("decoded").distinct()) == [("",), ("a</w> b</w>",)]
    assert B.encoded(frame([]), B.vocabulary(PATH)).count() == 0
    assert "N_tokens" not in B.digests(df, B.vocabulary(PATH)).columns
