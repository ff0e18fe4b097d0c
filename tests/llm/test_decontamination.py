"""op12 against plain loops over windows."""
import hashlib
import random
import re

from pyspark.sql import functions as F

from pansift.llm import decontamination as D
from pansift.llm.queries import item_digest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM_SCHEMA = "item_id long, text string, segment int, place int, items string"


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(text, size):
    w = split(text)
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def brute(pairs, items, size):
    out = []
    for i, text in pairs:
        w, hit, ids = split(text), set(), set()
        for item, t in items:
            for g in windows(t, size):
                for k in range(len(w) - len(g) + 1):
                    if tuple(w[k:k + len(g)]) == g:
                        hit |= set(range(k, k + len(g)))
                        ids.add(item)
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def answered(df):
    return sorted((tuple(r) for r in item_digest(df).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in items], ITEM_SCHEMA).repartition(2)


def test_equal_to_loops(spark, make):
    rs = random.Random(11)
    vocabulary = ["a", "b", "c", "été", "中文", "x1", "É"]
    def said(n):
        return " ".join(rs.choice(vocabulary) for _ in range(n))
    items = [(k, said(rs.randint(1, 9))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "?!"), (23, "unheard of words"), (24, items[0][1]), (0, items[0][1]), (0, "b b b a"), (None, "c c b"), (-7, "A-B,c")]
    pairs = [(k, said(rs.randint(0, 60))) for k in range(40)]
    pairs += [(3, pairs[3][1]), (3, pairs[3][1]), (None, said(30)), (None, None), (100, None), (101, ""), (102, " \t\n"), (103, "A. B; C\x00a b_c"),
              (104, "a " * 3000), (105, "b" * 5000)]
    for size in (1, 3, 4):
        assert answered(D.contamination(make(pairs), benchmark(spark, items), size)) == brute(pairs, items, size)


def test_given_tables(spark, edge, edge_pairs):
    long_item = " ".join(split(edge_pairs[3][1])[500:540])
    items = [(1, long_item), (2, "same text here now"), (3, "negative id second line"), (4, "not in any text")]
    got = answered(D.contamination(edge, benchmark(spark, items)))
    assert got == brute([p[:2] for p in edge_pairs], items, 10)
    assert {r[0] for r in got if r[5]} == {4, 5, 6, 7, -5, None}


def test_empty_tables(spark, edge, edge_pairs, empty):
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert D.contamination(empty, benchmark(spark, [(1, "a")])).count() == 0
    clean = D.contamination(edge, none).collect()
    assert len(clean) == len(edge_pairs) and {(r.n_hit, tuple(r["items"])) for r in clean} == {(0, ())}
    assert D.search(D.build_index(edge), none).count() == 0


def test_small_segments_steps_and_lots(spark, make, monkeypatch):
    rs = random.Random(2)
    pairs = [(k, " ".join(rs.choice("abcd") for _ in range(rs.randint(0, 40)))) for k in range(60)]
    items = [(k, " ".join(rs.choice("abcd") for _ in range(6))) for k in range(60)]
    monkeypatch.setattr(D, "LOT_BYTES", 300)  # the driver's side: several passes
    want = brute(pairs, items, 4)
    assert answered(D.contamination(make(pairs), benchmark(spark, items), 4)) == want
    lots = list(D._lots(benchmark(spark, items + items), "item_id", "text"))
    assert len(lots) > 3 and sorted(x for lot in lots for x in lot) == sorted(items)
    # the tasks' side, without Spark: one segment, steps of a few starts
    monkeypatch.setattr(D, "AT_ONCE", 7)
    s, w = D.invert([(i, D.words(t)) for i, t in pairs]), D.Windows(items, 4)
    found = {}
    for doc, item, a, b in D._stretches(s, w, *(lambda x, y: (x, y, y + w.lengths[x] - 1))(*w.phrases(s))):
        for d, i, x, y in zip(doc, item, a - s.starts[doc], b - s.starts[doc]):
            found.setdefault(pairs[d][0], [set(), set()])
            found[pairs[d][0]][0] |= set(range(x, y + 1))
            found[pairs[d][0]][1].add(str(w.ids[i]))
    assert sorted((i, len(h), len(n)) for i, (h, n) in found.items()) == sorted((r[0], r[2], r[3]) for r in want if r[5])


def test_phrases_are_joined_stretches(spark, make):
    index = D.build_index(make([(1, "x a b c d e y a b c"), (2, "c d e"), (3, "d c b a")]))
    got = D.search(index, benchmark(spark, [(9, "A b c D e"), (8, "d, e")]), 3).collect()
    assert sorted((r.doc_id, r.item_id, r["first"], r["last"]) for r in got) == [(1, 8, 4, 5), (1, 9, 1, 5), (1, 9, 7, 9), (2, 8, 1, 2), (2, 9, 0, 2)]


def test_proximity(spark, make):
    rs = random.Random(4)
    pairs = [(k, " ".join(rs.choice("abcdefgh") for _ in range(rs.randint(0, 30)))) for k in range(40)]
    items = [(k, " ".join(rs.choice("abcdefgh") for _ in range(3))) for k in range(8)] + [(90, "a"), (91, "z a")]
    for within in (3, 5):
        got = D.search(D.build_index(make(pairs)), benchmark(spark, items), 3, within).collect()
        have = {(r.doc_id, r.item_id) for r in got}
        want = set()
        for i, t in pairs:
            w = split(t)
            for item, q in items:
                if any(set(split(q)) <= set(w[k:k + within]) for k in range(len(w))):
                    want.add((i, item))
        assert have == want
        by_id, asked = dict(pairs), dict(items)
        for r in got:  # every joined stretch is made of short ones that hold all terms
            assert set(split(asked[r.item_id])) <= set(split(by_id[r.doc_id])[r["first"]:r["last"] + 1])
    exact = D._shortest(D.invert([(1, D.words("a x b a b"))]), {0, 1}, 3, 0, 4)
    assert exact == (2, 3)


def test_index_keeps_every_posting(spark, edge, edge_pairs):
    rows = D.build_index(edge)
    assert rows.agg(F.sum(F.size("doc_ids"))).first()[0] == len(edge_pairs)
    back = []
    for batch in rows.toArrow().to_batches():
        for _, s in D._segments(batch):
            at = {int(p): s.terms[int(k) // s.span] for k, p in zip(s.keys, s.positions)}
            back += [(i, [at[int(a) + k] for k in range(int(n))]) for i, a, n in zip(s.doc_ids, s.starts, s.sizes)]
    assert sorted(back, key=str) == sorted(((i, D.words(t)) for i, t, _ in edge_pairs), key=str)
    assert [w.decode() for w in D.words(edge_pairs[3][1])] == split(edge_pairs[3][1])
