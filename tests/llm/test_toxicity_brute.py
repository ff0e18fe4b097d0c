"""op4 against plain loops: features character by character, trees and isotonic steps by hand."""
import math
import re

import numpy as np
import pytest

from pansift.llm import toxicity as T


def plain_features(text, learnt):
    def weigh(token):
        words = re.findall(r"[^\W\d_]+", token)
        best = 0.0
        for w in words:
            for entry in ["=" + w, *(w[:n] for n in T.BEGINNINGS if len(w) >= n)]:
                best = max(best, learnt.get(entry, 0.0))
        return any(w in T.INSULTS for w in words), any(w in T.SECOND for w in words), best

    words = text.lower().split()
    n, marks = max(1, len(words)), [weigh(w) for w in words]
    insults = [i for i, m in enumerate(marks) if m[0]]
    second = [i for i, m in enumerate(marks) if m[1]]
    known = [(i, m[2]) for i, m in enumerate(marks) if m[2] > 0]
    near = sum(any(abs(i - j) <= T.NEAR for j in second) for i in {*insults, *(i for i, _ in known)})
    raw = text.encode()

    def kind(b):
        c = chr(b)
        if b >= 128 or "a" <= c <= "z":
            return "small"
        if "A" <= c <= "Z":
            return "capital"
        if c.isdigit() or c in "@$*|+":
            return "hiding"
        return "mark" if c in "!?" else "sign" if 33 <= b < 127 else "none"
    kinds = [kind(b) for b in raw]
    letter = [k in ("small", "capital") for k in kinds]
    capitals, letters, size = kinds.count("capital"), max(1, sum(letter)), max(1, len(raw))
    hidden = runs = stretched = shouted = 0
    if len(raw) > 2:
        for i in range(len(raw)):
            runs += i + 1 < len(raw) and kinds[i] == kinds[i + 1] == "mark"
            if i + 2 < len(raw):
                hidden += letter[i] and kinds[i + 1] == "hiding" and (letter[i + 2] or kinds[i + 2] == "hiding")
                stretched += letter[i] and raw[i] == raw[i + 1] == raw[i + 2]
                shouted += kinds[i] == kinds[i + 1] == kinds[i + 2] == "capital"
    found = [x.lower().translate(T._PLAIN) for x in T._MASKED.findall(text) + T._SPACED.findall(text)]
    uncovered = sum(any(m[:1]) or m[2] > 0 for m in map(weigh, filter(None, found)))
    return [len(insults) / n, math.log1p(len(insults)), sum(w for _, w in known) / n, math.log1p(len(known)),
            max((w for _, w in known), default=0.0), near / n, len(second) / n, capitals / letters, shouted / letters,
            raw.count(b"!") / size, raw.count(b"?") / size, sum(k in ("mark", "sign") for k in kinds) / size, runs / size,
            hidden / n, math.log1p(uncovered), stretched / n, math.log1p(len(words))]


TEXTS = ["", " ", "plain words of a text", "You IDIOT!! y0u st*pid f.o.o.l", "sh!t a1!b @ss $$ ||", "e s t ú p i d o you",
         "Aaaargh!!! WHY??? tú eres TONTO", "über cool 123 + 4*5", "i.m.b.é.c.i.l.e", "x" * 5000, "你 好 idiot ihr", "no-one's; (you) {clown}\n\nloser"]


@pytest.fixture(scope="module")
def model(spark):
    sf = "/root/testdata/sf0.1"
    return T.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return TEXTS + [r.text or "" for r in docs.orderBy("doc_id").limit(120).collect()]


def test_features(model, texts):
    weights = T.Remembered(model.lexicon.weight)
    for text in texts:
        assert T.features(text, weights) == pytest.approx(plain_features(text, model.lexicon.learnt), rel=1e-12, abs=1e-12), text[:60]


def grown(lines):
    """The nested conditions of one tree of ``toDebugString``."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        value = float(line.split(":")[1])
        return lambda x: value
    feature, bound = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line).groups()
    feature, bound = int(feature), float(bound)
    low = grown(lines)
    assert lines.pop(0).strip().startswith("Else")
    high = grown(lines)
    return lambda x: low(x) if x[feature] <= bound else high(x)


def test_scores(spark, model, texts):
    lines = model.trees.toDebugString.splitlines()[1:]
    trees = []
    while lines:
        weight = re.match(r"\s*Tree \d+ \(weight ([-\d.eE]+)\):", lines.pop(0))
        trees.append((float(weight[1]), grown(lines)))
    bounds, steps = (np.array(v.toArray()) for v in (model.steps.boundaries, model.steps.predictions))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in T.score(docs, model).collect()}
    for i, text in enumerate(texts):
        x = plain_features(text, model.lexicon.learnt)
        margin = sum(w * tree(x) for w, tree in trees)
        raw = 1 / (1 + math.exp(-2 * margin))
        want = 0.99 * float(np.interp(raw, bounds, steps)) + 0.01 * raw
        assert got[i].score == pytest.approx(want, rel=1e-9, abs=1e-12) and got[i].predicted == int(got[i].score >= 0.5)


def test_lexicon(spark):
    """Log-odds and deviations counted by hand."""
    rows = [(k, "zork other" if k % 3 == 0 else "plain other", int(k % 3 == 0)) for k in range(300)]
    sample = spark.createDataFrame(rows, "id long, text string, label int").select("text", "label")
    learnt = T.learn_lexicon(sample).learnt
    n, ones, p = 100, 100, 1 / 3
    odds = math.log((ones + 0.5) / 0.5) - math.log(p / (1 - p))
    assert (ones - n * p) / math.sqrt(n * p * (1 - p)) >= T.LEARNT_Z
    assert learnt == {e: pytest.approx(odds) for e in ("=zork", "zor", "zork")}
