"""op2 and op10 against the library itself."""
import hashlib
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pansift.llm import piece_codec
from pansift.llm.sentencepiece_codec import code_digests, decode, digests, encode
from pansift.llm.token_counts import count_tokens


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model)


def test_counts_equal_library(edge, edge_pairs, library):
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(edge).collect())
    want = sorted((i is None, i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t, _ in edge_pairs)
    assert got == want


def test_codes_equal_library(edge, edge_pairs, library):
    def of(t):
        ids = [1, *library.encode(t or ""), 2]
        return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in code_digests(edge).collect())
    assert got == sorted((i is None, i, *of(t)) for i, t, _ in edge_pairs)


def test_round_trip_tables(edge, edge_pairs, library):
    got = sorted((r.doc_id is None, r.doc_id, r.text) for r in decode(encode(edge)).collect())
    assert got == sorted((i is None, i, library.decode(library.encode(t or ""))) for i, t, _ in edge_pairs)


def test_empty_tables(empty):
    assert count_tokens(empty).count() == code_digests(empty).count() == decode(encode(empty)).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r▁the ing'\";(){}<>0x41"), st.characters(codec="utf-8")), max_size=40))
def test_any_text(text):
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    codec, sp = piece_codec.text_codec(path), piece_codec.pieces(path).sp
    ids = sp.encode(text)
    got = codec.encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == [1, *ids, 2]
    assert codec.decode(got) == sp.decode(ids)
    assert piece_codec.count_tokens(text, piece_codec.counter(path)) == len(ids)


@pytest.mark.parametrize("text", ["plain words of a text", "emoji 😀 and 中文 ", "  two  spaces ▁ "])
def test_decoded_digest_follows_the_ids(model, library, text):
    class Faulty(piece_codec.TextCodec):
        def encode(self, text):
            return super().encode(text)[:-8] + self.end  # the last id is lost

    def of(ids):
        return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    ids = library.encode(text)
    assert digests(piece_codec.TextCodec(model), text) == of([1, *ids, 2])
    assert digests(Faulty(model), text) == of([1, *ids[:-1], 2])


def test_every_shortcut_is_one_token(model, library):
    found = piece_codec.whole_tokens(model)
    assert len(found) > 10_000
    assert all(len(library.encode(k)) == 1 for k in found)


def test_memory_is_bounded(model, library):
    codec = piece_codec.TextCodec(model)
    codec.known.most = codec.codec.compatible.most = 50
    rs = random.Random(1)
    for _ in range(200):
        text = " ".join("".join(rs.choice("aeioustrnl.,") for _ in range(rs.randint(1, 9))) for _ in range(20))
        assert codec.encode(text) == piece_codec.packed([1, *library.encode(text), 2])
        assert len(codec.known) <= 50


def test_memory_is_bounded_in_bytes(model, library):
    """Texts without spaces: nothing of them stays, and counts and ids equal the library's."""
    rs = random.Random(5)
    codec, counts = piece_codec.TextCodec(model), piece_codec.counter.__wrapped__(model)
    fixed = len(counts.fixed)
    for _ in range(60):
        text = "".join(chr(rs.randint(0x4E00, 0x9FA5)) for _ in range(2000)) + "。\n" + "y" * rs.randint(65, 3000)
        assert codec.encode(text) == piece_codec.packed([1, *library.encode(text), 2])
        assert piece_codec.count_tokens(text, counts) == len(library.encode(text))
    assert len(codec.known) == 0 and len(counts) == fixed
    small = piece_codec.Remembered(lambda key: key * 2, most_bytes=10_000)
    for k in range(5000):
        assert small[f"key {k}"] == f"key {k}" * 2 and small.held <= 10_000 and len(small) < 100
    pairs = piece_codec.Remembered(lambda key: [key, (key, key)], most_bytes=50_000)
    assert [pairs[k] for k in range(1000)] == [[k, (k, k)] for k in range(1000)] and pairs.held <= 50_000


def test_long_texts_without_spaces(make, library):
    """Whole rows of them, through the operators."""
    pairs = [(k, chr(0x4E00 + k) * 30_000 + "字\n" * k) for k in range(6)]
    got = {r.doc_id: r.n_tokens for r in count_tokens(make(pairs)).collect()}
    codes = {r.doc_id: r.n_tokens for r in code_digests(make(pairs)).collect()}
    assert got == {i: len(library.encode(t)) for i, t in pairs} and codes == {i: n + 2 for i, n in got.items()}


def test_other_files_are_refused(edge):
    with pytest.raises(ValueError):
        count_tokens(edge, model="x.json")
