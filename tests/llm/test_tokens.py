"""Encoding, counting, packing and token files against the public libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgertide.llm import bpe, counts, library, packing, tokenfiles
from ledgertide.llm.chunks import chunk_starts, chunks, keeps_letters_whole
from ledgertide.llm.library import LibraryCodec, library_codec
from tests.llm.conftest import ROWS

CODEC = bpe.codec(P.path(bpe.DEFAULT_RANKS), P.PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})
COUNTER = counts.counter(P.path(counts.DEFAULT_TOKENIZER))
BYTE, WORD = (Tokenizer.from_file(P.path(n)) for n in (counts.DEFAULT_TOKENIZER, packing.DEFAULT_TOKENIZER))
TEXTS = st.text(st.sampled_from(" \n\taAbBéÉ'sreltm12½.,!?- ÀñıſK"), max_size=60) | st.text(max_size=40)


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def test_perfect_hash_is_minimal_and_tells_foreign_keys():
    table = CODEC.whole
    assert None not in table.keys and len(table.keys) == len(CODEC.ranks)
    assert all(table.get(k) == v for k, v in list(CODEC.ranks.items())[::97])
    assert table.get(b"surely not a token") is None
    assert bpe.PerfectHash({b"a": 1}).get(b"a") == 1 and bpe.PerfectHash({b"a": 1}).get(b"b") is None


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_texts_encode_as_the_libraries_do(text):
    data = CODEC.encode(text)
    assert ids(data) == TIKTOKEN.encode_ordinary(text) and CODEC.decode(data) == text.encode()
    for name, tokenizer in ((counts.DEFAULT_TOKENIZER, BYTE), (packing.DEFAULT_TOKENIZER, WORD)):
        assert ids(library_codec(P.path(name)).encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids
    n = len(BYTE.encode(text, add_special_tokens=False).ids)
    assert COUNTER.count(text) == n
    for limit in (0, 3, 9):
        fit = text[:COUNTER.fit(text, limit)]
        assert len(BYTE.encode(fit, add_special_tokens=False).ids) <= limit


@settings(max_examples=100, deadline=None)
@given(st.text(st.characters(categories=["L"]), max_size=20))
def test_every_prefix_has_its_exact_count(piece):
    table = COUNTER.prefix_counts(piece.encode())
    assert table == [len(bpe.merge_bytes(piece.encode()[:i], COUNTER.rank)) for i in range(len(piece.encode()) + 1)]


def test_queries_give_digests_and_keep_every_row(docs, none):
    want = sorted((r[0] or -1, hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in ROWS)
    assert sorted((r.doc_id or -1, r.decoded_sha256) for r in bpe.op1_byte_bpe(docs).collect()) == want
    got = counts.count_tokens(docs.withColumnRenamed("name", "n_tokens")).collect()
    assert len(got) == len(ROWS) and all(isinstance(r.n_tokens, int) for r in got)
    assert bpe.op1_byte_bpe(none).count() == counts.op7_prefix_counts(none).count() == 0


def test_packing_places_every_token_once(docs, none):
    pieces = packing.pack(docs, capacity=64, buffer_tokens=500).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for runs in by_sequence.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at and length > 0
            at += length
        assert at <= 64
    codec = library_codec(P.path(packing.DEFAULT_TOKENIZER))
    total = sum(len(codec.encode(r[1] or "")) // 4 + 1 for r in ROWS)
    assert sum(p.length for p in pieces) == total
    one = sorted(by_doc[5, by_doc_tokens(pieces, 5)], key=lambda p: p.start)
    assert b"".join(bytes(p.ids) for p in one) == codec.encode(next(r[1] for r in ROWS if r[0] == 5)) + np.array([2], "<u4").tobytes()
    assert packing.pack(none).count() == 0


def by_doc_tokens(pieces, doc):
    return next(p.doc_tokens for p in pieces if p.doc_id == doc)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=40))
def test_assignment_is_gapless_and_uses_the_fewest_sequences(lengths):
    placed = packing.assign(lengths, 32)
    assert sum(p[2] for p in placed) == sum(lengths)
    assert len({p[3] for p in placed}) <= -(-sum(lengths) // 32)


def test_token_files_come_back_in_order(docs, none):
    codec = library_codec(P.path(tokenfiles.DEFAULT_TOKENIZER))
    rows = sorted(tokenfiles.op10_token_files(docs).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in rows]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k) and len(keys) == len(ROWS)
    crc = {(r[0], zlib.crc32(codec.encode(r[1] or "") + bytes(4))) for r in ROWS}
    assert {(r.doc_id, r.ids_crc32) for r in rows} == crc
    assert tokenfiles.op10_token_files(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.data())
def test_segments_answer_any_range(values, data):
    whole = np.array(values, np.uint32)
    segment = tokenfiles.Segment(*tokenfiles.build_levels(whole))
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert segment.tokens(a, b).tolist() == values[a:b]
    if a < b:
        assert segment.token(a) == values[a]


def test_one_token_is_read_from_the_files(spark, docs, none, tmp_path):
    codec, path = library_codec(P.path(tokenfiles.DEFAULT_TOKENIZER)), str(tmp_path / "tokens")
    tokenfiles.write(docs, path, segment_tokens=50)
    for doc_id, text, *_ in (ROWS[0], ROWS[2], ROWS[5], ROWS[8]):
        right = [*ids(codec.encode(text or "")), tokenfiles.END_ID]
        for place in {0, len(right) // 2, len(right) - 1}:
            assert tokenfiles.token(spark, path, doc_id, place) == right[place]
        assert tokenfiles.token(spark, path, doc_id, len(right)) is None and tokenfiles.token(spark, path, doc_id, -1) is None
    assert tokenfiles.token(spark, path, 99, 0) is None
    tokenfiles.write(none, str(tmp_path / "none"))
    assert tokenfiles.token(spark, str(tmp_path / "none"), 1, 0) is None


def test_registered_columns_equal_the_libraries_on_a_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in table.select("doc_id", "text").collect()}
    digest = lambda values: hashlib.sha256(np.array(values, "<u4").tobytes()).hexdigest()
    for r in bpe.op1_byte_bpe(table).collect():
        right = TIKTOKEN.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(right), digest(right))
    sizes = {}
    for r in counts.op7_prefix_counts(table).collect():
        sizes[r.doc_id] = r.n_tokens
        assert r.n_tokens == len(BYTE.encode(texts[r.doc_id], add_special_tokens=False).ids)
    assert sizes.keys() == texts.keys()
    for r in tokenfiles.op10_token_files(table).collect():
        right = [*BYTE.encode(texts[r.doc_id], add_special_tokens=False).ids, tokenfiles.END_ID]
        assert (r.n_tokens, r.ids_crc32) == (len(right), zlib.crc32(np.array(right, "<u4").tobytes()))
    pieces = {}
    for r in packing.op5_cost_packing(table).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        right, at = np.array([*WORD.encode(text, add_special_tokens=False).ids, 2], "<u4"), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(right), zlib.crc32(right[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(right)


def test_words_with_and_without_marks_share_one_merge():
    for name, tokenizer in ((tokenfiles.DEFAULT_TOKENIZER, BYTE), (packing.DEFAULT_TOKENIZER, WORD)):
        codec, text = LibraryCodec(P.path(name)), "Zyxo zyxo zyxo, zyxo. zyxo?! it's 'st ?'s a9;"
        assert ids(codec.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids
        assert " zyxo," not in codec.piece_memo and not {"zyxo", " zyxo"} & set(codec.piece_memo) and any("zyxo" in c for c in codec.memo)
    assert CODEC.encode(" qvwx, qvwx") == CODEC.encode(" qvwx") + CODEC.encode(",") + CODEC.encode(" qvwx")
    assert " qvwx" in CODEC.memo and "," in CODEC.memo
    assert keeps_letters_whole(P.PATTERN) and not keeps_letters_whole("[a-z]+|.") and not keeps_letters_whole(r"\\d|[A-Z]| ?\\p{L}+")


def test_digests_need_no_text_back_from_the_workers(docs):
    coded = bpe.encode(docs, decoded="decoded", kept=["doc_id"])
    assert coded.columns == ["doc_id", "ids", "decoded"] and coded.count() == len(ROWS)
    assert bpe.encode(docs, kept=[]).columns == ["ids"]


MIXED = st.text(st.sampled_from(" \n\r\v\taAbBé×÷ßɏɐ\x85\xa0\u1680\u2003\u2028\u205f\u3000“中9.,!?'s\x1c"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(MIXED | TEXTS | st.sampled_from(["", "<|endoftext|>", "a <|endoftext|>b", "word,", " word"]), max_size=8))
def test_a_column_encodes_as_the_library_does(texts):
    codec = library_codec(P.path(tokenfiles.DEFAULT_TOKENIZER))
    want = [BYTE.encode(t, add_special_tokens=False).ids for t in texts]
    for kind in (pa.string(), pa.large_string()):
        assert [ids(x) for x in codec.encode_column(pa.array(["cut off", *texts], kind).slice(1))] == want
    plain = [t.encode() for t in texts if t and not set(t) & set("\x85\xa0\u1680\u2003\u2028\u205f\u3000")]
    if plain:
        begins = np.cumsum([0, *map(len, plain)])
        starts = chunk_starts(np.frombuffer(b"".join(plain), np.uint8), begins[:-1], False).tolist()
        cuts = [a + sum(map(len, (c.encode() for c in chunks(t.decode())[:i]))) for a, t in zip(begins, plain) for i in range(len(chunks(t.decode())))]
        assert starts == cuts


def test_a_word_of_many_texts_goes_to_the_model_once(monkeypatch):
    codec, asked = LibraryCodec(P.path(tokenfiles.DEFAULT_TOKENIZER)), []

    class Model:
        def tokenize(self, piece, own=codec.model):
            asked.append(piece)
            return own.tokenize(piece)

    codec.model = Model()
    texts = ["a borel, a borel. ", "The borel!"] * 500
    want = [BYTE.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(library, "UNIT_BYTES", 2000)  # in several slices
    assert [ids(x) for x in codec.encode_column(pa.array(texts))] == want
    assert asked.count("Ġborel") == 1
    monkeypatch.setattr(library, "UNITS_BYTES", 0)  # what is kept gives way each time
    assert [ids(x) for x in codec.encode_column(pa.array(texts))] == want
