"""Word-end BPE over rank arrays against the public library."""

import hashlib

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgertide.llm import rankarray as R
from tests.conftest import SF
from tests.llm.conftest import ROWS

FILE = P.path(R.DEFAULT_TOKENIZER)
CODEC, LIBRARY = R.codec(FILE), Tokenizer.from_file(FILE)
TEXTS = st.text(st.sampled_from(" \n\taAbBéÉ'sreltm12½.,!?- ÀñıſKİΣσςß中字あ한́̈\x85\x1c🙂"), max_size=60) | st.text(max_size=40)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def digests(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    return (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(want, skip_special_tokens=False).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.sampled_from(["", "<|endoftext|>", "<|startoftext|><|endoftext|>", "<|endoftext"]))
def test_texts_encode_and_decode_as_the_library_does(text, special):
    text = text[:9] + special + text[9:]
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    data = CODEC.encode(text)
    assert ids(data) == want and CODEC.decode(data) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.text("abcdefghinorst", min_size=1, max_size=700))
def test_arrays_and_heap_merge_alike(word):
    parts = [CODEC.id_of[c] for c in word[:-1]] + [CODEC.id_of[word[-1] + CODEC.suffix]]
    merged = R.merge_short(parts[:], CODEC.ranks, CODEC.made)
    assert merged == R.merge_long(parts[:], CODEC.ranks, CODEC.made) == LIBRARY.encode(word, add_special_tokens=False).ids


def test_a_word_of_any_length():
    word = "interna" * 9000
    assert ids(CODEC.encode(word)) == LIBRARY.encode(word, add_special_tokens=False).ids


def test_memos_that_overflow_change_nothing(monkeypatch):
    small = R.WordCodec(FILE)
    small.word_memo.entries, small.chunk_memo.entries = 3, 2
    text = "one two three four five six seven, one two. three! four five six"
    assert small.encode(text) == small.encode(text) == CODEC.encode(text)
    assert len(small.chunk_memo) <= 2 and len(small.chunk_memo.old) <= 2


def test_query_equals_the_library_on_a_given_table(spark):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = {r["doc_id"]: digests(r["text"] or "") for r in table}
    rows = R.op12_rank_array(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want and len(rows) == len(table)


def test_odd_rows_clashing_names_and_none(docs, none):
    rows = R.op12_rank_array(docs).collect()
    assert sorted((r.doc_id or -1, r.decoded_sha256) for r in rows) == sorted((r[0] or -1, digests(r[1] or "")[2]) for r in ROWS)
    odd = docs.selectExpr("text", "name AS IDS", "lang AS source", "lang AS c0", "doc_id AS d0", "name AS ids", "lang AS Text")
    coded = R.encode(odd, decoded="decoded")
    assert coded.columns == ["text", "IDS", "source", "c0", "d0", "Text", "ids", "decoded"] and coded.count() == len(ROWS)
    both = R.decode(R.encode(docs)).collect()
    assert all(r.decoded == LIBRARY.decode(ids(r.ids), skip_special_tokens=False) for r in both)
    unknown = docs.sparkSession.createDataFrame([(np.array([320, 60000], "<u4").tobytes(),), (None,)], "ids binary")
    assert {r.decoded for r in R.decode(unknown).collect()} == {LIBRARY.decode([320]), None}
    assert R.op12_rank_array(none).count() == 0
