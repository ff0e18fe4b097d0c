"""op13 against the tokenizers library, SentencePiece and byte-by-byte loops."""
import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pansift.llm import alignment as L


@pytest.fixture(scope="module")
def sides():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def al():
    import public_tokenizers as P
    return L.aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


def plain(text, sides):
    """Ids and owners of each byte, by the libraries."""
    a, sp = sides
    byte = L.byte_of_char()
    raw = (" " + text).encode()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = sp.encode(text)
    bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return [], [], [], []
    return ids_a, ids_b, [k for k, x in enumerate(bytes_a) for _ in x], [k for k, x in enumerate(bytes_b) for _ in x]


def brute(text, sides):
    """n_a, n_b, groups text, links as id pairs, all from the bytes' owners."""
    a, b, own_a, own_b = plain(text or "", sides)
    links = [(a[x], b[y]) for x, y in dict.fromkeys(zip(own_a, own_b))]
    groups, at_a, at_b = [], 0, 0
    for k in range(len(own_a)):
        if k + 1 == len(own_a) or (own_a[k] != own_a[k + 1] and own_b[k] != own_b[k + 1]):
            groups.append((a[at_a:own_a[k] + 1], b[at_b:own_b[k] + 1]))
            at_a, at_b = own_a[k] + 1, own_b[k] + 1
    return len(a), len(b), groups, links


def expected(pairs, sides):
    found = [(i, brute(t, sides)) for i, t in pairs]
    total = Counter(x for _, f in found for x in f[3])
    most = {}
    for (_, y), n in total.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for i, (n_a, n_b, groups, links) in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def answered(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_equal_to_bytes(edge, edge_pairs, sides):
    assert answered(L.link_counts(edge)) == expected([p[:2] for p in edge_pairs], sides)


def test_special_strings_and_marks(make, sides):
    pairs = [(k, f"word {k % 7} of the <|endoftext|> text, naïve café {'x' * k}") for k in range(40)] + [(None, None), (50, "▁")]
    want = expected(pairs, sides)
    assert answered(L.link_counts(make(pairs))) == want
    al = L.aligner(L.vocabulary("byte_bpe_50k.json"), L.vocabulary(L.VOCAB))
    assert [sum(r[k] for r in want) for k in (1, 2)] == [sum(map(len, side)) for side in zip(*al.tokens([t or "" for _, t in pairs]))]


def test_real_documents(spark, sides):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert answered(L.link_counts(docs.repartition(3))) == expected(pairs, sides)


def test_groups(make, sides):
    pairs = [(1, "Tokenization differs: 12345 été"), (2, None), (3, "a  b\n\n\tc"), (4, "two▁marks")]
    got = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in L.align(make(pairs)).collect()}
    assert got == {i: brute(t, sides)[2] for i, t in pairs}
    assert got[2] == got[4] == []


def test_empty_table(empty):
    assert L.link_counts(empty).count() == L.align(empty).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r▁the ing'\";(){}<>|0x41sé"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(text):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    sides = a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    al = L.aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    ids = next(iter(al.tokens([text])))
    n_a, n_b, groups, links = brute(text, sides)
    assert (len(ids[0]), len(ids[1])) == (n_a, n_b)
    assert al.groups(*ids) == groups
    link_a, link_b, n, _ = al.links(*ids)
    assert list(zip(link_a, link_b)) == links and n == len(groups)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=80), st.lists(st.integers(1, 3), min_size=1, max_size=80))
def test_runs_of_any_ends(a, b):
    ends_a, ends_b = [sum(a[:k + 1]) for k in range(len(a))], [sum(b[:k + 1]) for k in range(len(b))]
    last = min(ends_a[-1], ends_b[-1])  # both must reach the same end
    ends_a, ends_b = ([e for e in x if e < last] + [last] for x in (ends_a, ends_b))
    got = []
    for i, i2, j, j2, straight in L.diagonal_runs(ends_a, ends_b):
        got += [(ends_a[k], k + 1 - i, 1) for k in range(i, i2)] if straight else [(ends_a[i2 - 1], i2 - i, j2 - j)]
        assert ends_a[i2 - 1] == ends_b[j2 - 1] and (not straight or i2 - i == j2 - j)
    common = sorted(set(ends_a) & set(ends_b))
    assert [e for e, *_ in got] == common


def test_long_texts_in_parts(al, sides, monkeypatch):
    rs = random.Random(9)
    words = ["plain", "text.", "été,", "  two", "中文中文", "a\n", "12", "'s"]
    text = " ".join(rs.choice(words) for _ in range(4000))
    want = plain(text, sides)[:2]
    for size in (10, 50, 1000):
        monkeypatch.setattr(L, "parts", lambda t, size=size: ORIGINAL(t, size))
        assert next(iter(al.tokens([text]))) == (want[0], want[1])
    assert "".join(ORIGINAL(text, 10)) == text and len(ORIGINAL(text, 10)) > 100
    monkeypatch.setattr(L, "LONG", 5)
    assert next(iter(al.tokens(["x" * 50 + "  y"])))[0] == plain("x" * 50 + "  y", sides)[0]


ORIGINAL = L.parts


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        L.ByteLevel(L.vocabulary("word_bpe_49k.json"))


def test_packed_numbers():
    import numpy as np
    for x in ([], [0], [5, 4_294_967_295, 70_000, 1]):
        assert L._loosened(L._squeezed(np.array(x, np.uint32))).tolist() == x
