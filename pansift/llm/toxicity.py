"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

Features of a text (``FEATURES``): densities of a fixed and of a learnt
lexicon, how near lexicon words stand to a second person, capitals,
punctuation and obfuscation.  Labels are learnt from a bounded sample of
labelled rows (``FIT_ROWS``), never from the held-out fold.  The learnt lexicon
holds words and word beginnings that are far more frequent in texts with label
1.  Trees and calibration see each sampled text through a lexicon learnt
without its third of the sample, and are fitted on different rows; scoring
uses the lexicon of the whole sample.  Trees and calibration are Spark ML's;
scoring is one pass over the table without a shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pansift.llm._common import cut_lineage, prepare, quoted
from pansift.llm.piece_codec import Remembered

#: Labelled rows that are fitted on, at most; those with the smallest hash of their id.
FIT_ROWS = 20_000
#: Entries of the learnt lexicon, at most, and how far from chance each must be (in standard deviations).
LEARNT_ENTRIES, LEARNT_Z = 1000, 6.5
#: One row in so many calibrates, the others grow the trees.
CALIBRATED = 4
#: Lengths of word beginnings that the learnt lexicon may hold.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Words between a lexicon word and a second person that still count as near.
NEAR = 5

#: Plain insults of four languages.
INSULTS = frozenset("""
idiot idiots idiotic moron morons moronic stupid dumb dumbass fool imbecile cretin halfwit dimwit loser losers
pathetic worthless useless disgusting scum trash garbage filth filthy vermin clown coward liar ugly creep freak
pervert bastard jerk asshole bitch whore slut crap shit shitty fuck fucking retard retarded
idioten dumm dummkopf trottel depp versager abschaum dreck widerlich ekelhaft hurensohn arschloch scheisse
idiota estúpido estupido imbécil tonto basura asqueroso cabrón mierda puta inútil perdedor payaso
idiote imbécile stupide crétin débile ordure connard salope merde dégoûtant nul minable
""".split())
#: Second persons of four languages.
SECOND = frozenset("""
you your yours yourself ur du dich dir dein deine deiner euch euer ihr tú ti tus vos usted ustedes
tu toi ton tes vous votre vos
""".split())

FEATURES = ("insults", "insults_log", "learnt", "learnt_log", "learnt_most", "near_second", "second", "capitals",
            "shouted", "exclaimed", "asked", "punctuation", "runs", "obfuscated", "uncovered", "stretched", "words_log")

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W_]*[^\W\d_][0-9@$*!|+]+[^\W_][\w@$*!|+]*|\b[0-9@$!|][^\W\d_]+[\w@$!|]*")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][.\-*_ ]){3,}[^\W\d_](?![^\W_])")
_PLAIN = str.maketrans("0134578@$!|+", "oieastbasiit", "*.-_ ")
#: Kinds of bytes: 1 small letter or non-ASCII, 2 capital, 3 digit or sign used for hiding letters, 4 ! and ?, 5 other punctuation.
_KIND = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (1 if _b >= 128 or _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() or _c in "@$*|+"
                 else 4 if _c in "!?" else 5 if 33 <= _b < 127 else 0)


@dataclass
class Lexicon:
    """Learnt log-odds of words (``=word``) and word beginnings."""
    learnt: dict[str, float] = field(default_factory=dict)

    def weight(self, token: str) -> float:
        """Largest learnt weight of a token's words, plus 1000 if one is a
        plain insult, plus 10000 if one is a second person."""
        bare, get = token.strip(".,!?"), self.learnt.get
        words = (bare,) if bare.isalpha() else _WORD.findall(token)
        best = 0.0
        for word in words:
            best = max(best, get("=" + word, 0.0))
            for n in BEGINNINGS:
                if n <= len(word):
                    best = max(best, get(word[:n], 0.0))
        return best + 1000.0 * (not INSULTS.isdisjoint(words)) + 10000.0 * (not SECOND.isdisjoint(words))


def entries(text: str) -> set[str]:
    """What a text offers to the lexicon: words and word beginnings."""
    words = set(_WORD.findall(text.lower()))
    out = {"=" + w for w in words}
    for n in BEGINNINGS:
        out |= {w[:n] for w in words if len(w) >= n}
    return out


def features(text: str, weights: Remembered) -> list[float]:
    words = text.lower().split()
    n = max(1, len(words))
    marks = list(map(weights.__getitem__, words))
    marked = [(i, w) for i, w in enumerate(marks) if w] if any(marks) else []
    second = [i for i, w in marked if w >= 10000]
    insults = [i for i, w in marked if w % 10000 >= 1000]
    learnt = [(i, w % 1000) for i, w in marked if w % 1000 > 0]
    hits = sorted({*insults, *(i for i, _ in learnt)})
    beside = sum(bisect_left(second, i - NEAR) < bisect_right(second, i + NEAR) for i in hits) if second else 0
    raw = np.frombuffer(text.encode(), np.uint8)
    kind = _KIND[raw]
    count = np.bincount(kind, minlength=6)
    letters, size = max(1, int(count[1] + count[2])), max(1, len(raw))
    letter = (kind == 1) | (kind == 2)
    sign = (kind == 3) | (raw == 33)
    hidden = runs = stretched = shouted = 0
    masked, spaced = bool((sign[:-1] & letter[1:]).any()), False
    if len(raw) > 2:
        hidden = int((letter[:-2] & (kind[1:-1] == 3) & (letter[2:] | (kind[2:] == 3))).sum())
        masked = masked or bool((letter[:-2] & sign[1:-1] & (letter[2:] | sign[2:])).any())
        runs = int(((kind[:-1] == 4) & (kind[1:] == 4)).sum())
        stretched = int((letter[:-2] & (raw[:-2] == raw[1:-1]) & (raw[1:-1] == raw[2:])).sum())
        shouted = int(((kind[:-2] == 2) & (kind[1:-1] == 2) & (kind[2:] == 2)).sum())
    if len(text) > 6:
        # one byte for each code point: a letter may have several
        firsts = slice(None) if len(raw) == len(text) else (raw & 0xC0) != 0x80
        alone, gap = letter[firsts], ((kind == 0) | (kind == 5) | (raw == 42))[firsts]
        pair = alone[:-1] & gap[1:]
        spaced = bool((pair[:-5] & pair[2:-3] & pair[4:-1] & alone[6:]).any())
    # the byte kinds tell whether a pattern can match at all; most texts need no search
    found = _MASKED.findall(text) if masked else []
    found += _SPACED.findall(text) if spaced else []
    uncovered = sum(weights[w] % 10000 > 0 for w in (x.lower().translate(_PLAIN) for x in found) if w)
    return [len(insults) / n, math.log1p(len(insults)), sum(w for _, w in learnt) / n, math.log1p(len(learnt)),
            max((w for _, w in learnt), default=0.0), beside / n, len(second) / n, int(count[2]) / letters, shouted / letters,
            int((raw == 33).sum()) / size, int((raw == 63).sum()) / size, int(count[4] + count[5]) / size, runs / size,
            hidden / n, math.log1p(uncovered), stretched / n, math.log1p(len(words))]


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row belongs to the held-out fold (null ids do not)."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")), F.lit(5)) == 0, F.lit(False))


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    share: float

    def feature_udf(self):
        learnt = self.lexicon

        @F.pandas_udf("array<double>")
        def udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weights = Remembered(learnt.weight)
            for s in texts:
                yield pd.Series([features(t or "", weights) for t in s])
        return udf

    def with_score(self, rows: DataFrame, text_col: str = "text", name: str = "score") -> DataFrame:
        """``rows``, all columns, and the score.  A score is the calibrated
        probability; a hundredth of it is the uncalibrated one, so that the
        order within a step of the calibration is kept."""
        prepare(rows.sparkSession)
        if self.trees is None:
            return rows.withColumn(name, F.lit(float(self.share)))
        vector, prob, step = "__ps_vector", "__ps_probability", "__ps_step"
        trees = self.trees.copy().setFeaturesCol(vector).setProbabilityCol("__ps_p").setRawPredictionCol("").setPredictionCol("")
        out = trees.transform(rows.withColumn(vector, array_to_vector(self.feature_udf()(F.col(text_col)))))
        out = out.withColumn(prob, vector_to_array("__ps_p")[1])
        steps = self.steps.copy().setFeaturesCol(prob).setPredictionCol(step)
        out = steps.transform(out).withColumn(name, 0.99 * F.col(step) + 0.01 * F.col(prob))
        return out.select(*quoted(rows.columns), name)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The lexicon of ``text, label`` rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, ones = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = entries(text)
                seen.update(got)
                if label:
                    ones.update(got)
            # what no text with label 1 holds cannot become an entry
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64()),
                 pa.array([ones[k] for k in seen], pa.int64())], names=["entry", "n", "ones"])

    total = sample.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    p = (total.ones or 0) / max(1, total.n)
    if not 0 < p < 1:
        return Lexicon()
    counts = (sample.select("text", "label").mapInArrow(count, "entry string, n long, ones long")
              .groupBy("entry").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).where("ones >= 3"))
    z = (F.col("ones") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
    odds = F.log((F.col("ones") + 0.5) / (F.col("n") - F.col("ones") + 0.5)) - math.log(p / (1 - p))
    rows = (counts.withColumn("z", z).withColumn("odds", odds).where((F.col("z") >= LEARNT_Z) & (F.col("odds") > 1))
            .orderBy(F.desc("z"), "entry").limit(LEARNT_ENTRIES).collect())
    return Lexicon({r.entry: float(r.odds) for r in rows})


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Learn from the rows of ``docs`` that ``labels`` names, without the held-out fold.

    Null labels are skipped; of several labels of an id the largest counts;
    null ids are not learnt from.  With no or only one label value the score
    is the share of label 1.
    """
    prepare(docs.sparkSession)
    known = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__label"))
             .where(F.col("__id").isNotNull() & F.col("__label").isNotNull() & ~held_out("__id"))
             .groupBy("__id").agg(F.max("__label").alias("__label"))
             .orderBy(F.xxhash64("__id"), "__id").limit(fit_rows))
    known = cut_lineage(known, "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # at most fit_rows ids and labels are broadcast
    sample = texts.join(F.broadcast(known), "__id").select(
        "text", F.col("__label").alias("label"), F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(3 * CALIBRATED)).alias("part"))
    sample = cut_lineage(sample, "sample")
    share = sample.agg(F.avg("label").alias("p")).first().p
    model = Model(learn_lexicon(sample), None, None, share or 0.0)
    seen = None
    for k in range(3):
        without = Model(learn_lexicon(sample.where(F.col("part") % 3 != k)), None, None, 0.0)
        fold = sample.where(F.col("part") % 3 == k).select(
            array_to_vector(without.feature_udf()(F.col("text"))).alias("features"),
            F.col("label").cast("double").alias("label"), "part")
        seen = fold if seen is None else seen.unionByName(fold)
    rows = cut_lineage(seen.coalesce(6), "features")
    calibrates = F.col("part") >= 3 * (CALIBRATED - 1)
    trees, steps = rows.where(~calibrates), rows.where(calibrates)
    if trees.select("label").distinct().count() < 2 or steps.select("label").distinct().count() < 2:
        return model
    model.trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=7, minInstancesPerNode=3).fit(trees)
    scored = model.trees.transform(steps).select("label", vector_to_array("probability")[1].alias("features"))
    model.steps = IsotonicRegression().fit(scored)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per input row.

    Null texts are scored as empty ones; null ids are not held out; repeated
    rows give repeated results; other columns are not read; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return model.with_score(rows).select("doc_id", held_out().alias("held_out"), "score",
                                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
