"""op3, op5, op8 and op9 against brute force."""
import base64
import glob
import hashlib
import io
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pansift.llm import ann, mixing, sharding, warc

PAGES = [(3, "http://a/3", "<p>é</p>" * 50), (1, "http://a/1\r\nX: y", "<p>é</p>" * 50), (2, None, None), (5, "u", ""),
         (None, "n", "<p>é</p>" * 50), (None, None, "only\r\n\r\nhere"), (7, "big", "<b>" + "word " * 400_000), (8, "x", "tiny")]
PAGES += [(100 + k, f"http://s/{k}", f"<html><body>page {k % 90} of many</body></html>") for k in range(300)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "k", "d") for p in PAGES], "page_id long, url string, html string, key string, digest string").repartition(4)


@pytest.mark.parametrize("least,archive_bytes", [(0, 1 << 25), (20, 4000)])
def test_archives_round_trip(spark, pages, least, archive_bytes):
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(pages, folder, least, archive_bytes)
    got = warc.read_archives(manifest, folder).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, u, h in PAGES:
        raw = (h or "").encode()
        again = len(raw) >= least and first.get(h or "") != i
        url = None if u is None else re.sub(r"[\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", u)
        want.append((i, url, "revisit" if again else "response", len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     first.get(h or "") if again else None, None if again else raw))
    have = [(r.page_id, r.url, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to,
             None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)


def test_archive_is_standard_frames(spark, pages):
    import zstandard
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(pages, folder)
    assert warc.read_archives(warc.write_archives(pages.limit(0), folder), folder).count() == 0
    for name in (r.path for r in manifest.collect()):
        data = open(re.sub("^file:/*", "/", folder) + "/" + name, "rb").read()
        assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
        size = int.from_bytes(data[4:8], "little")
        d = zstandard.ZstdCompressionDict(data[8:8 + size])
        whole = zstandard.ZstdDecompressor(dict_data=d).stream_reader(io.BytesIO(data[8 + size:]), read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\n") >= 1 and whole.endswith(b"\r\n\r\n")


def test_damage_is_noticed():
    raw = warc.record(1, "u", b"payload", 7, warc.digest(b"payload"), None)
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"payload\r", b"paYload\r"))
    data = warc.archive([raw] * 20)
    assert len(list(warc.read_archive(io.BytesIO(data)))) == 20
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[:-3])))


# -- mixing -----------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: k % 3 + 1 for k, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        unit = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * unit > 3 * sizes[s]}
        if not over:
            out |= {s: w[s] * unit for s in free}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mix_against_brute_force(make, edge, edge_pairs, empty):
    big = [(k, "w " * (1 + k * 7919 % 50), ["x", "y", "z", "\U0001F600", "￿", None][min(5, k % 9)]) for k in range(3000)]
    big += [(9000 + k, "few words", "small") for k in range(4)]
    for pairs, docs in ((big, make(big, 7)), (edge_pairs, edge)):
        rows = mixing.mix(docs).collect()
        sizes, taken = defaultdict(int), defaultdict(int)
        for i, t, s in pairs:
            sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        want, largest = brute_targets(sizes), defaultdict(int)
        assert len(rows) == len(pairs)
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
            assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
        for s in sizes:
            # rows with equal id and text are taken together
            assert abs(taken[s] - want[s]) <= 3 * largest[s]
        again = mixing.mix(docs.repartition(2)).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
        mixed = mixing.mixed_rows(docs)
        assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(empty).count() == mixing.mixed_rows(empty).count() == 0


def test_mix_budgets_are_nested(make):
    docs = make([(k, "a b c", "s") for k in range(500)])
    rows = docs.select(F.lit("s").alias("source"), F.lit(3).cast("long").alias("size"), mixing.row_hash("doc_id", "text").alias("u"))
    cuts = []
    for target in (0.0, 100.0, 700.0, 1499.0):
        plan = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("target", F.lit(target))
        cut = mixing.thresholds(rows, plan).first()
        assert cut.passes == 0 and abs(3 * rows.where(F.col("u") < cut.threshold).count() - target) <= 3
        cuts.append(cut.threshold)
    assert cuts == sorted(cuts)


# -- shards -----------------------------------------------------------------------

def smallest_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, need, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                need, at = need + 1, 0
            at += s
        low, high = (low, mid) if need <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 2, 5, 24])
def test_cuts_are_minimax(spark, shards):
    rs = np.random.default_rng(shards)
    keys = np.unique(np.concatenate([rs.integers(-2**63, 2**63 - 1, 3000), np.arange(-2**63, -2**63 + 5), np.arange(2**63 - 5, 2**63 - 1)]))
    sizes = rs.integers(8, 5000, len(keys))
    groups = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes)], "key long, bytes long")
    cuts = sharding.cut_keys(groups, shards)
    sums = np.add.reduceat(sizes, np.unique(np.concatenate([[0], np.searchsorted(keys, cuts)]).astype(int)))
    assert len(sums) <= shards and sums.max() == smallest_capacity(sizes.tolist(), shards)


def test_shards_of_documents(make, edge, edge_pairs, empty):
    hot = [(k, "copied " * 30) for k in range(800)] + [(1000 + k, f"text number {k} " + "x" * (k % 40)) for k in range(1600)]
    for pairs, docs, shards in ((hot, make(hot, 5), 24), (hot, make(hot, 2), 3), (edge_pairs, edge, 24)):
        rows = sharding.shard(docs, shards).collect()
        assert len(rows) == len(pairs)
        where, slots, bytes_of = defaultdict(set), defaultdict(list), defaultdict(int)
        import zlib
        text = sorted((p[0] is None, p[0], len((p[1] or "").encode()) + 8, zlib.crc32((p[1] or "").encode())) for p in pairs)
        assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in rows) == text
        for r in rows:
            where[r.text_crc32].add(r.shard)
            slots[r.shard].append(r.slot)
            bytes_of[r.shard] += r.size
            assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        assert all(len(s) == 1 for s in where.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if pairs is hot and shards == 24:
            own = 800 * 218
            others = [b for b in bytes_of.values() if b != own]
            assert len(others) == 23 and max(others) - min(others) < 2000
    assert sharding.shard(empty).count() == 0


# -- search -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(spark):
    rs = np.random.default_rng(4)
    x = rs.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(k, [float(v) for v in row], "s", 1) for k, row in enumerate(x)]
    rows += [(5000, None, "s", 1), (5020, [0.0] * 16, "s", 1), (5040, [float("nan")] * 16, "s", 1), (5060, [1.0, None] * 8, "s", 1),
             (5080, [float("inf")] * 16, "s", 1), (5100, [1.0] * 3, "s", 1), (None, [1.0] * 16, "s", 1), (5120, [], "s", 1), rows[20], rows[7]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, part int").repartition(5), x.astype(np.float64)


def brute_nearest(x, q, k):
    s = np.add.reduce(x * x[q], axis=1)
    s[q] = -np.inf
    order = np.lexsort((np.arange(len(x)), -s))[:k]
    return [(int(i), float(s[i])) for i in order]


def test_all_parts_give_the_exact_result(vectors):
    df, x = vectors
    got = defaultdict(list)
    for r in ann.search(df, visits=10**6).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert sorted(got) == list(range(0, 3000, 20))
    for q, found in got.items():
        want = brute_nearest(x, q, 20)
        assert [i for i, _ in found] == [i for i, _ in want]
        assert np.allclose([s for _, s in found], [s for _, s in want], rtol=1e-12, atol=1e-12)


def test_recall(vectors):
    df, x = vectors
    got = defaultdict(set)
    for r in ann.search(df).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(found & {i for i, _ in brute_nearest(x, q, 20)}) for q, found in got.items())
    assert len(got) == 150 and hits >= 0.9 * 20 * len(got)


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    got = defaultdict(set)
    for r in ann.search(df).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(got[int(ids[q])] & {int(ids[i]) for i, _ in brute_nearest(x, q, 20)}) for q in np.flatnonzero(ids % 20 == 0))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    assert ann.search(spark.createDataFrame([], schema)).count() == 0
    assert ann.search(spark.createDataFrame([(20, [1.0, 2.0])], schema)).count() == 0
    got = ann.search(spark.createDataFrame([(20, [1.0, 2.0]), (3, [2.0, 0.0]), (1, [2.0, 0.0])], schema)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(20, 1, 1, 2.0), (20, 2, 3, 2.0)]


def _clusters(n, at, rs):
    """One vector in ``at`` lies far from the others, in a small cluster of its own."""
    return [(k, (rs.normal(size=8) * 0.05 + 9 * np.eye(8)[1 if k % at == 0 else 0]).tolist()) for k in range(n)]


@pytest.mark.parametrize("n, kind", [(15, "even"), (30, "even"), (120, "even"), (300, "even"), (200, "clusters"), (300, "repeats")])
def test_rows_per_query(spark, n, kind):
    rs = np.random.default_rng(n)
    rows = _clusters(n, 20, rs) if kind == "clusters" else [(k, rs.normal(size=8).tolist()) for k in range(n)]
    if kind == "repeats":
        rows += [(7, (np.array(rows[20][1]) * (30 + j)).tolist()) for j in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(r.query_id for r in ann.search(df, visits=1).select("query_id", "vec_id").distinct().collect())
    assert got == {q: min(20, n - 1) for q in range(0, n, 20)}


def test_parts_visited_hold_enough():
    logits = np.array([[3.0, 2.0, 1.0, 0.0], [0.0, 1.0, 2.0, 3.0]])
    to, ends = ann.visited(logits, np.array([5, 0, 17, 100]), 1, 20)
    assert (to.tolist(), ends.tolist()) == ([0, 1, 2, 3], [0, 3, 4])
    to, ends = ann.visited(logits, np.array([5, 0, 7, 3]), 2, 20)
    assert (to.tolist(), ends.tolist()) == ([0, 1, 2, 3, 3, 2, 1, 0], [0, 4, 8])


def test_parts_are_balanced():
    rs = np.random.default_rng(1)
    x = rs.normal(size=(1000, 8))
    part = ann.balanced_parts(x, ann.neighbours(x, x, 10, own=True), 8)
    assert len(np.unique(part)) == 8 and np.bincount(part).max() <= np.ceil(1.1 * 1000 / 8)
