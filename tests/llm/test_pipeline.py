"""op4, the pipeline and the entry."""
import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from pansift.llm import mixing, simhash, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, model):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    found = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    false = sum(r.predicted for r in rows if not r.toxic) / sum(not r.toxic for r in rows)
    assert right > 0.97 and found > 0.88 and false < 0.01


def test_scores_of_edges(edge, edge_pairs, empty, model):
    rows = toxicity.score(edge, model).collect()
    assert len(rows) == len(edge_pairs)
    import zlib
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert toxicity.score(empty, model).count() == 0
    assert model.with_score(edge, name="s").columns == [*edge.columns, "s"]


def test_scores_depend_on_the_text_alone(make, model):
    text = "some plain text " * 10
    a = toxicity.score(make([(1, text, "x"), (77, text, None), (None, text, "y")]), model).collect()
    assert len({r.score for r in a}) == 1


def test_without_labels(spark, edge, empty):
    for rows in ([], [(1, 1, 1)], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1), (3, 1, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        fitted = toxicity.fit(edge, labels)
        assert fitted.trees is None and toxicity.score(edge, fitted).where("score between 0 and 1").count() == edge.count()
    assert toxicity.fit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).share == 0


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score(docs, toxicity.fit(docs, x)).collect()) for x in (labels, turned))
    assert np.allclose([s for _, s in a], [s for _, s in b])


def test_features_find_hidden_words():
    weights = toxicity.Remembered(toxicity.Lexicon({"zork": 3.0}).weight)
    at = dict(zip(toxicity.FEATURES, toxicity.features("You are an IDIOT!!! zorkish m0r0n l-o-s-e-r sooo bad", weights)))
    assert at["insults"] > 0 and at["near_second"] > 0 and at["learnt_most"] == 3.0 and at["uncovered"] > 0
    assert at["runs"] > 0 and at["stretched"] > 0 and at["shouted"] > 0
    assert len(toxicity.features("", weights)) == len(toxicity.FEATURES)


@pytest.mark.parametrize("text", ["you sh!t", "b!tch", "B!TCH, go", "st!nk", "a1!b", "1x", "e s t ú p i d o", "i.m.b.é.c.i.l.e",
                                  "é-é-é-é", "D É B I L E", "m-o-r-o-n", "r a t t é d i o t i m b é c i l e s"])
def test_signs_and_accents_hide_words(text):
    weights = toxicity.Remembered(toxicity.Lexicon({"=stink": 3.0, "=aiib": 3.0, "=ix": 3.0, "=éééé": 3.0, "rat": 3.0}).weight)
    assert dict(zip(toxicity.FEATURES, toxicity.features(text, weights)))["uncovered"] > 0


def test_no_gate_hides_a_match():
    rs = random.Random(5)
    weights = toxicity.Remembered(lambda w: 1.0)
    at = toxicity.FEATURES.index("uncovered")
    for _ in range(20_000):
        text = "".join(rs.choice("aBé中😀1!@*|. -_,?") for _ in range(rs.randint(1, 14)))
        found = [x.lower().translate(toxicity._PLAIN) for x in toxicity._MASKED.findall(text) + toxicity._SPACED.findall(text)]
        assert toxicity.features(text, weights)[at] == pytest.approx(np.log1p(sum(w != "" for w in found))), text


# -- pipeline ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory, make):
    """Documents with planted copies, near copies and toxic texts, and their labels."""
    rs = random.Random(9)
    syllables = ["ka", "lo", "mi", "ru", "te", "sa", "no", "vi", "pe", "du"]
    word = lambda: "".join(rs.choice(syllables) for _ in range(rs.randint(1, 4)))
    clean = lambda n: " ".join(word() for _ in range(n))
    pairs, labels, plan = [], [], {}
    for k in range(300):
        toxic = k % 4 == 0
        text = clean(rs.randint(40, 120))
        if toxic:
            w = text.split()
            for _ in range(8):
                w.insert(rs.randrange(len(w)), rs.choice(["idiot", "moron", "scum"]))
            text = " ".join(w)
        pairs.append((k, text, f"src{k % 4}"))
        labels.append((k, 1, int(toxic)))
        plan[k] = "toxic" if toxic else "clean"
    base = {i: t for i, t, _ in pairs if plan[i] == "clean"}
    for k, i in enumerate(list(base)[:40]):
        pairs.append((1000 + k, base[i].replace(" ", "  "), "src1"))  # equal but for white space, and longer
        plan[i], plan[1000 + k] = "copy", "clean"
    pairs += [(2000, None, None), (2001, "", "src9"), (1, pairs[1][1], pairs[1][2])]
    folder = str(tmp_path_factory.mktemp("corpus"))
    make(pairs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, pairs, plan


def test_stages_against_brute_force(spark, corpus):
    from test_dedup import brute_components, brute_fingerprint, exact_brute
    folder, pairs, plan = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, folder), "test")
        if k < 4:
            assert docs.columns == columns
            after = Counter(tuple(r) for r in docs.select("doc_id", "text", "source").collect())
        if name == "toxicity":
            gone = {r[0] for r in before} - {r[0] for r in after}
            bad = {i for i, p in plan.items() if p == "toxic"}
            assert len(gone & bad) >= 0.95 * len(bad) and not gone - bad
        elif name == "exact dedup":
            want = sorted((r[0] for r in exact_brute([(i, t) for i, t, _ in before]) if r[3]), key=str)
            assert sorted((r[0] for r in after.elements()), key=str) == want
            assert not [i for i, p in plan.items() if p == "copy" and i in want]
        elif name == "simhash near-dedup":
            fps = np.array([brute_fingerprint(t) for _, t, _ in before], np.uint64)
            least = {}
            roots = brute_components(fps, 4)
            for (i, _, _), r in zip(before, roots):
                least[r] = min(least.get(r, i), i)
            assert sorted(r[0] for r in after.elements()) == sorted(least.values())
        elif name == "source mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(before, "doc_id long, text string, source string")).collect()}
            assert Counter({r[0]: n for r, n in after.items()}) == Counter({i: n for i, n in copies.items() if n})
        else:
            import public_tokenizers
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            want = []
            for i, t, _ in before:
                ids = [1, *sp.encode(t or ""), 2]
                want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                             hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
            assert sorted(map(tuple, docs.collect())) == sorted(want)


def test_stages_of_edges(spark, edge, empty, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(6, 1, 1), (7, 0, 0), (8, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for docs in (edge, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut_lineage(stage(spark, docs, folder), "test")
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert docs.count() == 0


def test_near_copies_go_by_row(spark, make):
    rs = random.Random(2)
    text = lambda: " ".join("".join(rs.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    a, b, c, d, e, f = (text() for _ in range(6))
    near = lambda t: t + " end"
    pairs = [(3, a), (7, near(a)), (7, b), (None, near(a) + " x"), (None, c), (None, d), (None, near(d)), (None, c),
             (9, e), (9, near(e)), (12, f), (12, f), (12, near(f))]
    fps = [simhash.fingerprint(t, corpus_pipeline.SHINGLE) for _, t in pairs]
    linked = lambda x, y: (fps[x] ^ fps[y]).bit_count() <= corpus_pipeline.DISTANCE
    assert linked(0, 1) and linked(0, 3) and linked(5, 6) and linked(8, 9) and linked(10, 12) and not linked(0, 2)
    docs = make(pairs)
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(3, a), (7, b), (None, c), (None, d), (9, e), (12, f)], key=str)


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_queries_equal_their_sql(spark):
    import duckdb
    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    from pansift.llm import queries
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, sf)
        cur = con.execute(sql)
        columns = [c[0] for c in cur.description]
        assert sorted(columns) == sorted(got.columns), name
        assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, cur.fetchall())), name


def test_columns_with_dots_and_maps(spark):
    """Stages keep columns whatever their names and types, also of repeated rows."""
    rows = [(k, t, "en", "s", len(t or ""), "x", {"a": (k or 0) % 3}, [{"b": None}]) for k, t in
            [(1, "one text of five words"), (1, "one text of five words"), (2, "one text of five words"), (None, "quite another text in here"),
             (None, "quite another text in here"), (3, None), (3, None)]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, `m``x` map<string, int>, l array<map<string, int>>"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns and kept.schema["m`x"].dataType == docs.schema["m`x"].dataType, name
        got = [(r.doc_id, r.text, r["a.b"], r["m`x"]) for r in kept.collect()]
        if "dedup" in name:
            assert sorted({(i, t) for i, t, *_ in got}, key=str) == sorted([(1, rows[0][1]), (None, rows[3][1]), (3, None)], key=str)
            assert len(got) == 3 and all(m["a"] == (i or 0) % 3 for i, _, _, m in got)
