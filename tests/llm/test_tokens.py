import base64
import functools
import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import DOCS, corpus, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickforge.llm import bpe, library_tokens, pfor, text_blocks, token_counts, token_files

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = st.text(alphabet="aabinghet 'sll\n\t\r1é漢😀!?.-=  \x1ćẞÄ", max_size=80)


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_transducer_is_the_library(tik):
    own = bpe.text_encoder(RANKS, bpe.split_pattern())
    rnd, pool = random.Random(5), [*"aaabcd \n'", "the ", "ing", "漢字", "😀", "ß", "tion", "====", "\r\n", "   "]
    for _ in range(1500):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60)))
        assert _ids(own.encode(text)) == tik.encode_ordinary(text), text


@settings(max_examples=150, deadline=None)
@given(text=TEXTS)
def test_transducer_on_drawn_texts(tik, text):
    assert _ids(bpe.text_encoder(RANKS, bpe.split_pattern()).encode(text)) == tik.encode_ordinary(text)


def test_transducer_with_tiny_caches(tik, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 5)
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    own = bpe.TextEncoder(bpe.read_ranks(RANKS), bpe.split_pattern())
    for _, text, *_ in corpus(20)[:20]:
        assert _ids(own.encode(text)) == tik.encode_ordinary(text)


def test_compatible_pairs_are_those_that_merging_keeps():
    ranks = bpe.read_ranks(RANKS)
    machine, rnd, all_ids = bpe.Transducer(ranks), random.Random(2), sorted(ranks.values())
    short = [r for r in all_ids if len(machine.spelling[r]) <= 3][:1500]
    for _ in range(4000):
        a, b = rnd.choice(short), rnd.choice(short)
        assert machine._fits(a, b) == (bpe.merge(machine.spelling[a] + machine.spelling[b], ranks) == [a, b])


def test_one_long_pretoken_takes_linear_time(tik):
    own, text = bpe.text_encoder(RANKS, bpe.split_pattern()), "ab" * 200_000 + "a" * 1001
    assert b"".join(tik.decode_single_token_bytes(i) for i in _ids(own.encode(text))) == text.encode()
    assert _ids(own.encode(text[:4000])) == tik.encode_ordinary(text[:4000])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 255), max_size=12))
def test_decoder_replaces_malformed_parts(tik, byte_ids):
    ranks = bpe.read_ranks(RANKS)
    ids = [ranks[bytes([b])] for b in byte_ids]
    assert "".join(bpe.decoder(RANKS).decode(ids)) == bytes(byte_ids).decode("utf-8", "replace")


def test_decoder_writes_characters_when_complete():
    text, rest = bpe.utf8_step(b"", "a漢".encode()[:-1])
    assert (text, rest) == ("a", "漢".encode()[:-1])
    assert bpe.utf8_step(rest, "漢".encode()[-1:]) == ("漢", b"")
    assert list(bpe.decoder(RANKS).decode([10 ** 6])) == ["�"]


@settings(max_examples=150, deadline=None)
@given(text=TEXTS, size=st.integers(1, 20))
def test_cuts_are_safe(tik, text, size):
    parts = list(text_blocks.blocks(text, size))
    assert "".join(parts) == text
    assert sum((tik.encode_ordinary(p) for p in parts), []) == tik.encode_ordinary(text)


def _odd_rows(spark):
    rows = corpus(30)
    rows += [rows[2], (7, "x   y   \n", "en", "s", 1), (8, "<|endoftext|> a<|endoftext|>b <|startoftext|>", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr(
        "*", "1 as ids", "2 as n_tokens", "3 as n_bytes", "4 as decoded", "5 as id", "6 as start")
    return rows, docs


def test_encode_and_decode_rows(spark, tik):
    rows, docs = _odd_rows(spark)
    back = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    want = [(r[0], bytearray(np.array(tik.encode_ordinary(r[1] or ""), "<u4").tobytes()), r[1] or "") for r in rows]
    assert rows_of(back) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(docs.limit(0), RANKS), RANKS).collect() == []


def _library(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


def test_counts_match_the_library(spark):
    rows, docs = _odd_rows(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [(r[0], len((r[1] or "").encode()), len(_library("byte_bpe_50k.json", r[1]))) for r in rows]
    assert rows_of(token_counts.count_tokens(docs, path)) == sorted(want, key=repr)
    assert rows_of(token_counts.count_tokens(docs, path, batch_bytes=64)) == sorted(want, key=repr)
    assert token_counts.count_tokens(docs.limit(0), path).collect() == []


@settings(max_examples=100, deadline=None)
@given(text=TEXTS, name=st.sampled_from(["byte_bpe_50k.json", "word_bpe_49k.json"]))
def test_chunks_encode_as_the_whole(text, name):
    own = library_tokens.LibraryTokens(public_tokenizers.path(name), list)
    assert sum(own.parts([text])[0], []) == _library(name, text)


def test_latin_words_encode_as_the_library():
    own = library_tokens.LibraryTokens(public_tokenizers.path("word_bpe_49k.json"), list)
    assert own.lower_words
    assert not library_tokens.LibraryTokens(public_tokenizers.path("byte_bpe_50k.json"), list).lower_words
    rnd = random.Random(4)
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()] + list("abcdetnirsABC") * 20
    for i in range(1500):
        text = " ".join("".join(rnd.choices(letters, k=rnd.randint(1, 9))) + rnd.choice(["", "", ".", ",", "'s", "\u0301"])
                        for _ in range(4))
        assert sum(own.parts([text])[0], []) == _library_of(own, text), text


def _library_of(own, text):
    return own.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2 ** 32 - 1)), min_size=1, max_size=200))
def test_block_round_trip(ids):
    ids = np.array(ids, np.uint64).astype("<u4")
    assert (pfor.decode_block(pfor.encode_block(ids)) == ids).all()


def test_block_patches_outliers():
    ids = np.full(1000, 7, "<u4")
    ids[[3, 500]] = 2 ** 32 - 1
    data = pfor.encode_block(ids)
    assert len(data) == 16 + 2 * 8 and (pfor.decode_block(data) == ids).all()


def test_file_round_trip_and_random_access(monkeypatch):
    monkeypatch.setattr(pfor, "BLOCK_VALUES", 64)
    rng, out = np.random.default_rng(0), io.BytesIO()
    docs = [(None if i == 4 else -i, rng.integers(0, 49408, n, dtype=np.uint64).astype("<u4"))
            for i, n in enumerate([0, 1, 63, 64, 65, 0, 500, 3])]
    writer = pfor.Writer(out)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    reader = pfor.Reader(out, len(out.getvalue()))
    assert [(i, x.tobytes()) for i, _, x in reader] == [(i, x.tobytes()) for i, x in docs]
    assert all((reader.document(i) == x).all() for i, (_, x) in enumerate(docs))


def test_token_files(spark, tmp_dir):
    rows, docs = _odd_rows(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_files.write_token_files(docs, f"{tmp_dir}/a", path, end_id=1)
    got = sorted(token_files.read_token_files(spark, f"{tmp_dir}/a").collect(), key=lambda r: r.start)
    ids = {r: np.array([*_library("word_bpe_49k.json", r[1]), 1], "<u4") for r in set(rows)}
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(_ids(r.ids))
        at += r.n_tokens
    want = sorted((repr(r[0]), zlib.crc32(ids[r].tobytes())) for r in rows)
    assert sorted((repr(r.doc_id), zlib.crc32(r.ids)) for r in got) == want
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows)


def test_token_files_of_an_empty_table(spark, tmp_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(spark.createDataFrame([], DOCS), f"{tmp_dir}/b", path)
    assert token_files.read_token_files(spark, f"{tmp_dir}/b").collect() == []


def test_digest_columns(spark, tik):
    from clickforge.llm.queries import op2_byte_bpe
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op2_byte_bpe(spark, sf).collect():
        ids = np.array(tik.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_a_text_without_unfinished_sequences_is_decoded_in_one_go(tik):
    own, ranks, rnd = bpe.Decoder({r: t for t, r in bpe.read_ranks(RANKS).items()}), bpe.read_ranks(RANKS), random.Random(8)
    pool = [ranks[bytes([b])] for b in range(256)] + sorted(ranks.values())[300:700] + [10 ** 6]
    for _ in range(800):
        ids = [rnd.choice(pool) for _ in range(rnd.randint(0, 9))]
        assert own.text(ids) == "".join(own.decode(ids)), ids


def test_each_chunk_is_split_and_encoded_once(tik):
    own, calls = bpe.TextEncoder(bpe.read_ranks(RANKS), bpe.split_pattern()), []
    split = own.split
    own.split = lambda text: calls.append(text) or split(text)
    text = "the same, words again. " * 50
    for _ in range(3):
        assert _ids(own.encode(text)) == tik.encode_ordinary(text)
    assert len(calls) == len(set(calls)) == 6, calls


def test_pairs_of_tokens_are_tried_once(monkeypatch):
    machine, tried = bpe.Transducer(bpe.read_ranks(RANKS)), []
    cut = machine._stays_cut
    monkeypatch.setattr(machine, "_stays_cut", lambda a, b: tried.append((a, b)) or cut(a, b))
    for piece in (b" reendhanth", b" thandreend", b" ndharenthe") * 3:
        machine.encode(piece)
    assert tried and len(tried) == len(set(tried))


@settings(max_examples=100, deadline=None)
@given(text=st.text(alphabet="ab'.,1\u00e9\u6f22\u0301\u0130 \t\n\xa0\u2003\x1c", max_size=40))
def test_odd_blanks_and_marks(tik, text):
    assert _ids(bpe.text_encoder(RANKS, bpe.split_pattern()).encode(text)) == tik.encode_ordinary(text)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        assert sum(_lists(name).parts([text])[0], []) == _library_of(_lists(name), text)


@functools.cache
def _lists(name):
    return library_tokens.LibraryTokens(public_tokenizers.path(name), lambda ids: [int(i) for i in ids])


def test_long_chunks_are_not_kept_and_known_ones_not_asked_again(monkeypatch):
    own, asked = library_tokens.LibraryTokens(public_tokenizers.path("word_bpe_49k.json"), list), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda chunks: asked.extend(chunks) or learn(chunks))
    for _ in range(2):
        got = own.parts(["so many words, " + "x1" * 40 + " end", "so many"])
        assert sum(got[0], []) == _library_of(own, "so many words, " + "x1" * 40 + " end")
    assert asked.count(" many") == 1 and sum(len(c) > 40 for c in asked) == 2
    assert all(len(c) <= library_tokens.KEPT_CHUNK for c in own.known)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.lists(st.sampled_from(
    ["The", "the.", "It's,", "J\u030c", "I\u0307!", "a\u0301b.", "\u6f22a;", "...", "?!x", "3.5", "\xa0", "\x1c", " ", "\n", "\u0301", "\u0130.",
     "\u03a3.", "\u039f\u03a3", "caf\xe9,", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>.B"])).map("".join)), max_size=5))
def test_ids_of_many_texts_are_the_librarys(texts):
    own = _ids_of("word_bpe_49k.json")
    assert own.drops_blanks
    assert [_ids(x) for x in own.ids(texts)] == [_library_of(own, t) for t in texts]


def test_ids_of_other_vocabularies_keep_blanks():
    own = _ids_of("byte_bpe_50k.json")
    assert not own.drops_blanks
    texts = ["The  the.\n", "", "a<|endoftext|> b"]
    assert [_ids(x) for x in own.ids(texts)] == [_library_of(own, t) for t in texts]


@functools.cache
def _ids_of(name):
    return library_tokens.library_ids(public_tokenizers.path(name))


def test_a_word_is_asked_for_once_whatever_its_case_blanks_and_marks(monkeypatch):
    own, asked = library_tokens.LibraryIds(public_tokenizers.path("word_bpe_49k.json")), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda chunks: asked.extend(chunks) or learn(chunks))
    text = "Word, word words.\nWORD  words! word."
    assert _ids(b"".join(own.ids([text] * 3))) == _library_of(own, text) * 3
    assert sorted(asked) == ["!", ",", ".", "word", "words"]


def test_ids_with_a_tiny_cache(monkeypatch):
    monkeypatch.setattr(library_tokens, "MAX_CHUNKS", 3)
    own = library_tokens.LibraryIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r[1] or "" for r in corpus(25)]
    for at in range(0, len(texts), 4):
        assert [_ids(x) for x in own.ids(texts[at:at + 4])] == [_library_of(own, t) for t in texts[at:at + 4]]


def test_token_files_of_texts_in_several_calls(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(token_files, "CALL_BYTES", 50)
    rows, docs = _odd_rows(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(docs, f"{tmp_dir}/c", path, end_id=1)
    got = token_files.read_token_files(spark, f"{tmp_dir}/c").collect()
    want = [(r[0], [*_library("word_bpe_49k.json", r[1]), 1]) for r in rows]
    assert sorted(((r.doc_id, _ids(r.ids)) for r in got), key=repr) == sorted(want, key=repr)
