import random

import pytest
from pyspark.sql import types as T

VOCAB_MODEL = "piece_bpe_32k.model"
#: Names that operators might use themselves.
CLASHING = ["n", "key", "fp", "size", "rank", "line", "digest", "score", "u", "cell", "features"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.StringType()) for c in CLASHING])


def rows(pairs):
    """Full rows for (doc_id, text) or (doc_id, text, source)."""
    out = []
    for p in pairs:
        i, text, source = p if len(p) == 3 else (*p, "s")
        out.append((i, text, "en", source, len(text or ""), *CLASHING))
    return out


@pytest.fixture(scope="session")
def edge_pairs():
    rs = random.Random(3)
    words = ["alpha", "beta", "Gamma", "delta,", "été", "中文", "you", "idiot", "▁x", "<s>", "a\tb"]
    long_text = " ".join(rs.choice(words) for _ in range(30_000)) + "\n" + "x" * 20_000
    plain = [(k, " ".join(rs.choice(words) for _ in range(rs.randint(1, 40))), rs.choice(["a", "b", None])) for k in range(20, 60)]
    return [(1, None, "a"), (2, "", None), (3, " \t\r\n ", "b"), (4, long_text, "a"), (5, long_text + " ", "b"),
            (6, "same text here now", "a"), (6, "same text here now", "a"), (7, "same text here now", None),
            (None, "same  text here now", "a"), (None, None, None), (None, None, None), (8, "A", "c"), (9, "a", "c"),
            (-5, "negative id\r\nsecond line", "a"), (10, "emoji 😀 and nul \x00 end", "b"), *plain]


@pytest.fixture(scope="session")
def edge(spark, edge_pairs):
    return spark.createDataFrame(rows(edge_pairs), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    return lambda pairs, parts=3: spark.createDataFrame(rows(pairs), SCHEMA).repartition(parts)


@pytest.fixture(scope="session")
def model():
    import public_tokenizers
    return public_tokenizers.path(VOCAB_MODEL)
