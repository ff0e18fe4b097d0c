"""op1, op6 and op7 against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pansift.llm import exact_dedup, line_dedup, simhash


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def lines_brute(pairs):
    """Lines in one place (rows that share an id, or have none) go by their hash."""
    import xxhash

    def hashed(line):
        h = xxhash.xxh64_intdigest(line.encode(), seed=42)
        return h - (1 << 64) if h >> 63 else h
    at, rows = {}, []
    order = lambda line, p: (p[0] is None, p[0] or 0, p[1], hashed(line))
    for i, t in pairs:
        for k, line in enumerate((t or "").split("\n")):
            line = line.strip(" \t\x0b\x0c\r")
            rows.append((i, k, line))
            if line and (line not in at or order(line, (i, k)) < order(line, at[line])):
                at[line] = (i, k)
    keep = {}
    for line, p in at.items():
        best = line, p
        if len(line) >= line_dedup.NEAR_CHARS:
            for other, q in at.items():
                if len(other) >= line_dedup.NEAR_CHARS and order(other, q) < order(*best) and within_one(line, other):
                    best = other, q
        keep[line] = best
    out, stayed = [], set()
    for i, k, line in rows:
        other, place = keep.get(line, (line, (i, k)))
        stays = not line or (other == line and place == (i, k) and line not in stayed)
        if line and stays:
            stayed.add(line)
        out.append((i, k, stays, *place))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def near_pairs():
    rs = random.Random(5)
    letters = "abcdé "
    base = ["".join(rs.choice(letters) for _ in range(n)).strip() + "x" for n in (15, 16, 17, 18, 33, 60, 200, 700, 3000)]
    out = []
    for k in range(120):
        got = []
        for _ in range(rs.randint(1, 6)):
            s = list(rs.choice(base))
            for _ in range(rs.choice([0, 1, 1, 1, 2])):
                p = rs.randrange(len(s))
                kind = rs.randrange(3)
                if kind == 0:
                    s[p] = rs.choice("zé中")
                elif kind == 1:
                    del s[p]
                else:
                    s.insert(p, rs.choice("zab"))
            got.append(rs.choice(["", " "]) + "".join(s) + rs.choice(["", "\t", "\r"]))
        out.append((k, "\n".join(got)))
    # one frame, many lines; every line within one edit of every other
    out += [(1000 + k, "the same frame with one place: " + chr(0x4E00 + k) + " and its end") for k in range(300)]
    return out


def test_lines_against_brute_force(make, near_pairs):
    got = line_dedup.dedup_lines(make(near_pairs)).collect()
    got = sorted(((r.doc_id, r.line_no, r.kept, r.keep_doc_id, r.keep_line_no) for r in got), key=str)
    assert got == lines_brute(near_pairs)
    assert sum(not r[2] for r in got) > 300


def test_lines_edges(edge, edge_pairs, empty):
    pairs = [(i, t) for i, t, _ in edge_pairs]
    got = sorted(((r.doc_id, r.line_no, r.kept, r.keep_doc_id, r.keep_line_no)
                  for r in line_dedup.dedup_lines(edge).collect()), key=str)
    assert got == lines_brute(pairs)
    assert line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("floor", [2, 9])
def test_short_lines_below_the_usual_floor(make, monkeypatch, floor):
    rs = random.Random(8)
    pairs = [(k, "\n".join("".join(rs.choice("abé") for _ in range(rs.choice([1, 2, 3, 5, 8, 9, 10, 15, 16]))) for _ in range(4)))
             for k in range(60)]
    pairs += [(100, "Read more >"), (101, "Read more »"), (102, "a line of 15 ch"), (103, "a line of 15 chs")]
    got = line_dedup.dedup_lines(make(pairs), near_chars=floor).collect()
    got = sorted(((r.doc_id, r.line_no, r.kept, r.keep_doc_id, r.keep_line_no) for r in got), key=str)
    monkeypatch.setattr(line_dedup, "NEAR_CHARS", floor)
    assert got == lines_brute(pairs)
    assert {(101, 0, False, 100, 0), (103, 0, False, 102, 0)} <= set(got)


def test_lines_without_an_id_go_as_well(make):
    rs = random.Random(12)
    base = ["a line that is long enough to be near", "another line that is long enough", "short"]
    lines = ["".join(c if rs.random() > 0.03 else "z" for c in rs.choice(base)) for _ in range(300)]
    got = line_dedup.dedup_lines(make([(None, x) for x in lines])).collect()
    assert sorted(((r.doc_id, r.line_no, r.kept, r.keep_doc_id, r.keep_line_no) for r in got), key=str) == lines_brute([(None, x) for x in lines])
    assert sum(r.kept for r in got) <= len(set(lines))
    twice = line_dedup.dedup_lines(make([(5, lines[0] + "\n" + lines[1])] * 3 + [(4, lines[1])])).collect()
    assert sum(r.kept for r in twice) == len({lines[0], lines[1]})


def test_lines_of_documents(make):
    docs = make([(1, "first line of all the lines\nsecond"), (2, "second\nfirst line of all the lined\nthird\n"), (3, None)])
    got = {r.doc_id: r.text for r in line_dedup.without_repeats(docs).collect()}
    assert got == {1: "first line of all the lines\nsecond", 2: "third\n", 3: ""}


def test_lines_run_no_python(edge):
    plan = line_dedup.dedup_lines(edge)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_fingerprint(text, k=4):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= distance):
            root[find(i)] = find(i + 1 + int(j))
    return [find(i) for i in range(len(fps))]


def test_near_duplicates_against_brute_force(edge, edge_pairs, empty):
    fps = np.array([brute_fingerprint(t) for _, t, _ in edge_pairs], np.uint64)
    roots = brute_components(fps, 4)
    ids = {}
    for (i, _, _), r in zip(edge_pairs, roots):
        if i is not None:
            ids[r] = min(ids.get(r, i), i)
    want = sorted(((i, f"{int(f):016x}", ids.get(r)) for (i, _, _), f, r in zip(edge_pairs, fps, roots)), key=str)
    got = simhash.near_duplicates(edge).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [8, 4096])
def test_links_lose_nothing(spark, block):
    rs = np.random.default_rng(2)
    centres = rs.integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    fps = [np.uint64(0)]
    for c in centres:
        x = c
        for _ in range(rs.integers(1, 30)):  # chains: each a few bits from the one before
            for b in rs.choice(64, rs.integers(1, 7), replace=False):
                x = x ^ np.uint64(1 << int(b))
            fps.append(x)
    crowd = centres[0]
    fps += [crowd ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a in range(40, 56) for b in range(40, 56)]
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    found = {r.node: r.root for r in simhash.components(simhash.links(df, 4, block)).collect()}
    roots = brute_components(fps, 4)
    signed = fps.view(np.int64)
    least = {}
    for f, r in zip(signed, roots):
        least[r] = min(least.get(r, int(f)), int(f))
    assert all(found.get(int(f), int(f)) == least[r] for f, r in zip(signed, roots))


def test_fewest_segments():
    assert simhash.segments(4) == [(0, 21), (21, 22), (43, 21)]
    assert [len(simhash.segments(d)) for d in range(6)] == [1, 1, 2, 2, 3, 3]


def exact_brute(pairs):
    groups = {}
    for i, t in pairs:
        t = t or ""
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest()
        groups.setdefault(key, []).append((-len(t), i is None, i or 0, i))
    out = []
    for key, g in groups.items():
        best = min(g)
        kept = False
        for x in sorted(g):
            stays = x == best and not kept
            kept |= stays
            out.append((x[3], best[3], len(g), stays, key))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_shard", [3, 50_000])
def test_exact_against_brute_force(edge, edge_pairs, per_shard):
    got = exact_dedup.dedup(edge, per_shard=per_shard).collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str)
    assert got == exact_brute([(i, t) for i, t, _ in edge_pairs])


def test_exact_history_decides_membership_only(make):
    pairs = [(k, f"text {k % 7}" + " " * (k % 3)) for k in range(60)] + [(100, "new"), (101, "n e w")]
    docs = make(pairs)
    for history in (None, F.col("doc_id") < 5, F.lit(True), F.lit(False)):
        got = exact_dedup.dedup(docs, history).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == exact_brute(pairs)
    known = {r.doc_id: r.known for r in exact_dedup.dedup(docs, F.col("doc_id") < 50).collect()}
    assert known[59] and not known[101]


def test_exact_survivors_keep_columns(edge, edge_pairs, empty):
    got = exact_dedup.survivors(edge)
    assert got.columns == edge.columns
    want = sorted((r[0] for r in exact_brute([(i, t) for i, t, _ in edge_pairs]) if r[3]), key=str)
    assert sorted((r.doc_id for r in got.collect()), key=str) == want
    assert exact_dedup.survivors(empty).count() == exact_dedup.dedup(empty).count() == 0


def test_rows_without_id_meet_only_their_own_digest(make):
    docs = make([(None, f"text number {k}") for k in range(400)] + [(5, f"another one {k}") for k in range(400)])
    got = exact_dedup.survivors(docs)
    assert len({r.text for r in got.collect()}) == got.count() == 800
    plan = got._jdf.queryExecution().sparkPlan().toString()
    joins = re.findall(r"(?:SortMergeJoin|HashJoin) (\[.*?\]), \[", plan)
    assert joins and all("__sha" in keys for keys in joins)


def test_perfect_hash_is_minimal():
    digests = [hashlib.sha256(str(k).encode()).digest() for k in range(5000)]
    words = exact_dedup._words(digests)
    sizes, bits, slots = exact_dedup.perfect_hash(words)
    assert sorted(slots) == list(range(5000))
    assert (exact_dedup.find_slots(words, sizes, bits) == slots).all()
    with pytest.raises(ValueError):
        exact_dedup.perfect_hash(exact_dedup._words([digests[0]] * 2))


def test_many_rows_of_one_text_without_an_id(spark):
    """A hundred thousand equal rows: one stays, and no task sorts them (no window over their key)."""
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text")).unionByName(
        spark.createDataFrame([(3, "other"), (None, "other")], "doc_id long, text string"))
    got = exact_dedup.dedup(docs)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = got.groupBy("doc_id", "keep_id", "group_size", "kept").count().collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(None, None, 100_000, True, 1), (None, None, 100_000, False, 99_999),
                                                        (3, 3, 2, True, 1), (None, 3, 2, False, 1)], key=str)
    assert exact_dedup.survivors(docs).count() == 2
