"""Importance resampling, sharding and vector codes against brute force, and their edges."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolytics.llm import importance, sharding, vector_codes
from aerolytics.llm import queries as Q
from tests.conftest import SF01, SF001
from tests.llm.llm_data import documents, edge_rows, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


# 11 ---------------------------------------------------------------------------------------
def features(text):
    w = WORD.findall((text or "").translate(UPPER))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def resampled(docs, target, percent=25, min_words=20, k=10_000):
    def buckets(texts):
        c = [0] * k
        for t in texts:
            for f in features(t)[1]:
                c[zlib.crc32(f.encode()) % k] += 1
        return c
    s, t = buckets(x for _, x in docs), buckets(target)
    gains = [math.floor(1000 * math.log(((t[b] + 1) * (sum(s) + k)) / ((s[b] + 1) * (sum(t) + k)))) for b in range(k)]
    out, able = [], []
    for i, x in docs:
        w, f = features(x)
        weight = sum(gains[zlib.crc32(g.encode()) % k] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if len(w) >= min_words:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = n + 1
    return collections.Counter(map(tuple, out))


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_op11_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    assert rows(Q.op11_importance(spark, sf)) == resampled(docs, target)


def test_op11_edges(spark):
    bench = spark.createDataFrame([("w1 w2 w3",), (None,), ("",)], "text string")
    for d in (documents(spark, edge_rows()), documents(spark, edge_rows(), clashes=True)):
        got = importance.resample(d, bench, percent=80, min_words=1)
        assert rows(got) == resampled([(r[0], r[1]) for r in edge_rows()], ["w1 w2 w3"], 80, 1)
    assert importance.resample(empty(spark), bench).count() == 0
    assert importance.resample(documents(spark, edge_rows()), bench.limit(0)).count() == len(edge_rows())


@given(st.lists(st.text(alphabet=st.sampled_from("aZ0 é\x7f\n-_漢\U0001f600"), max_size=30) | st.none()
                | st.just("a" * 70 + " b " + "c" * 65), max_size=8))
@settings(max_examples=200, deadline=None)
def test_op11_buckets_equal_crc(texts):
    one, two, cuts = importance.feature_buckets(pa.array(["x", *texts], pa.string()).slice(1), 10_000)
    for text, a, b in zip(texts, cuts[:-1], cuts[1:]):
        w, f = features(text)
        assert [*one[a:b], *two[a:b][:-1]] == [zlib.crc32(x.encode()) % 10_000 for x in f]
        assert b == a or two[b - 1] == -1
        assert len(w) == b - a


@pytest.mark.parametrize("bits,block_rows", [(11, 1 << 20), (6, 7)])
def test_op11_radix_ranks(spark, tmp_path, bits, block_rows):
    rnd = random.Random(4)
    data = [(rnd.choice([None, 5, -3, -(1 << 63), (1 << 63) - 1, rnd.randrange(-99, 99)]), rnd.randrange(40), i)
            for i in range(500)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(data, "id long, score long, n long").repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    ids = F.col("id").bitwiseXOR(F.lit(-1 << 63))
    parts = [(F.lit(39) - F.col("score"), 6), (F.col("id").isNull().cast("long"), 1),
             (F.coalesce(ids, F.lit(0).cast("long")), 64)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        out = sorted(importance.radix_ranks(table, parts, len(data), bits, block_rows).collect(), key=lambda r: r["pos"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r["pos"] for r in out] == list(range(500))
    key = [(-r["score"], r["id"] is None, r["id"] or 0) for r in out]
    assert key == sorted(key)
    place = {r["n"]: (r["f"], r["i"]) for r in table.select("n", F.col("_metadata.file_name").alias("f"),
                                                            F.col("_metadata.row_index").alias("i")).collect()}
    for a, b, x, y in zip(out, out[1:], key, key[1:]):                  # stable
        assert x < y or place[a["n"]] < place[b["n"]]


# 12 ---------------------------------------------------------------------------------------
def check_shards(out, n, n_shards):
    by = collections.defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[k]) for k in range(n_shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and set(by) <= set(range(n_shards))


def test_op12_holds_the_law_and_every_row(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    out = Q.op12_sharding(spark, SF01).collect()
    check_shards(out, len(docs), 24)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in out} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert {(r["law"], r["grown_shard"]) for r in out} == {("rows", None)}
    again = Q.op12_sharding(spark, SF01).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in out} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_op12_is_uniform(spark, tmp_path):
    """Neighbours of the input are strangers in the output, under several seeds."""
    path = str(tmp_path / "d")
    spark.range(6000).select("id", F.lit("same text").alias("text")).coalesce(2).write.parquet(path)
    seen = []
    for seed in (1, 2):
        out = sharding.shard_documents(spark.read.parquet(path), 6, seed).collect()
        check_shards(out, 6000, 6)
        order = [r["id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
        table = np.zeros((6, 6))                          # shard against sixth of the input
        for k, i in enumerate(order):
            table[k // 1000, i // 1000] += 1
        chi = ((table - 1000 / 6) ** 2 / (1000 / 6)).sum()
        assert chi < 60                                   # 25 degrees of freedom
        steps = np.diff(order)
        assert abs(np.corrcoef(order[:-1], order[1:])[0, 1]) < 0.06 and (steps == 1).sum() < 12
        seen.append(order)
    assert seen[0] != seen[1]


def test_op12_edges_and_files(spark, tmp_path):
    for d in (documents(spark, edge_rows()), documents(spark, edge_rows(), clashes=True).withColumn("shard", F.lit("x"))):
        path = str(tmp_path / f"s{len(d.columns)}")
        out = sharding.write_shards(d, path, 5, bucket_bytes=1 << 16)
        kept = [c for c in d.columns if c != "shard"]
        assert out.columns == [*kept, "shard", "slot"]
        check_shards(out.collect(), len(edge_rows()), 5)
        assert rows(out.select(kept)) == rows(d.select(kept))
        places = out.select("shard", "slot", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")) \
            .orderBy("f", "i").collect()
        for a, b in zip(places, places[1:]):
            assert a["f"] != b["f"] or (a["shard"] == b["shard"] and a["slot"] < b["slot"])
    assert sharding.shard_documents(empty(spark)).count() == 0


# 13 ---------------------------------------------------------------------------------------
def coded(rows_, parts=4, entries=256, rounds=4):
    kept = [(i, lab, [math.floor(1024 * x) for x in v]) for i, lab, v in rows_
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = -(-max((len(r[2]) for r in kept), default=0) // parts)
    m = np.array([r[2] + [0] * (width * parts - len(r[2])) for r in kept], dtype=object).reshape(len(kept), parts, width)
    books = [[list(m[i, p]) for i in range(min(entries, len(kept)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(m[i, p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
                for i in range(len(kept))]
    for _ in range(rounds):
        best = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [m[i, p] for i in range(len(kept)) if best[i][p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    best = assign()
    text = ",".join(str(x) for b in books for e in b for x in e)
    error = [sum(d for d, _ in b) for b in best]
    of = collections.Counter()
    for r, e in zip(kept, error):
        of[r[1]] += e
    return collections.Counter((r[0], "".join(f"{k:02x}" for _, k in b), e, of[r[1]], hashlib.sha256(text.encode()).hexdigest())
                               for r, b, e in zip(kept, best, error))


VECTORS = "vec_id long, embedding array<double>, label int, code string, v int"


def test_op13_against_brute_force_and_edges(spark):
    rnd = random.Random(3)
    data = [(i, [rnd.gauss(0, 1) for _ in range(6)], rnd.choice([1, 1, 1, 2, None])) for i in range(60)]
    data += [(3, data[3][1], 1), (None, data[9][1], 2), (70, None, 1), (71, [1.0, None, 0, 0, 0, 0], 1), (72, [float("nan")] * 6, 1),
             (73, [float("inf")] + [0.0] * 5, 1), (74, [], 1), (75, [0.5, 2.0], None), (-5, [300.5, -300.25, 0, 0, 0, 0.0], 7)]
    rnd.shuffle(data)
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "c", 1)
                                   for i, v, lab in data], VECTORS)
    got = vector_codes.compress_vectors(frame.repartition(3), parts=4, entries=8, rounds=3)
    assert rows(got) == coded([(i, lab, v) for i, v, lab in data], 4, 8, 3)
    assert vector_codes.compress_vectors(frame.limit(0)).count() == 0
    assert rows(vector_codes.compress_vectors(frame.where("vec_id < 0"))) == coded([(-5, 7, [300.5, -300.25, 0, 0, 0, 0])])


def test_op13_nearest_equals_plain_distances():
    rng = np.random.default_rng(1)
    for high in (40, 3000, 1 << 28):
        block, books = rng.integers(-high, high, (3000, 32)), rng.integers(-high, high, (4, 16, 8))
        books[:, 5] = books[:, 2]                          # ties
        codes, error = vector_codes.nearest(block.astype(np.int32), books)
        d = ((block.reshape(3000, 4, 1, 8) - books[None]) ** 2).sum(axis=3)
        assert (codes == d.argmin(axis=2)).all() and (error == d.min(axis=2).sum(axis=1)).all()
    assert 16 * (2 * vector_codes.component_limit(16)) ** 2 < 1 << 63
