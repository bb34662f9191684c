"""Similarity operators against brute force, with the odd rows."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from retenta.llm import collision, egojoin, simhash
from retenta.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VECS = "vec_id long, embedding array<float>, label int"


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 5), (9, 8), (1, 1), (None, 2), (20, 9), (3, 4)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 8: 8, 9: 8, 20: 8} | {100 + i: 100 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def test_fingerprint_is_the_definition(spark):
    texts = [None, "", " \t\n", "One", "ONE two", "a b c", "a  b\tc d É", "x " * 3000]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    mine = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t")).first()[0] % (1 << 64)
    assert simhash.fingerprint("A b C") == mine  # one shingle is its own hash


@pytest.mark.parametrize("chunk", [2048, 8])
def test_fingerprint_links_lose_nothing(spark, chunk):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 6), replace=False))) for b in base for _ in range(20)]
    crowd = [base[0] ^ np.uint64(1 << i) for i in range(64)]
    fps = np.unique(np.array([*base, *near, *crowd], dtype=np.uint64))
    label = np.arange(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            label[label == label[j]] = label[i]
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r["id"]: r["component"] for r in components(simhash.fingerprint_links(rows, chunk=chunk)).collect()}
    mine = [got.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert len(set(zip(mine, label.tolist()))) == len(set(mine)) == len(set(label.tolist()))


def test_near_duplicates_odd_rows(spark):
    rows = [(1, None, "x", "s", 0), (2, "", None, None, None), (3, "a b c d e", "x", "s", 1), (7, "A b c d e", "x", "s", 1), (7, "A b c d e", "x", "s", 1),
            (None, "a b c d e", "x", "s", 1), (9, "w%d " * 5 % tuple(range(5)) + "y " * 20000, "x", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("component_id", F.lit("clash")).withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows) and all(len(r["fingerprint"]) == 16 for r in got)
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(1, 1), (2, 1), (3, 3), (7, 3), (7, 3), (9, 9)]
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [3]
    assert sorted(r["doc_id"] or 0 for r in simhash.keep_one(docs).collect()) == [0, 1, 3, 9]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def vectors(rng, n, dim):
    centres = rng.standard_normal((n // 8, dim))
    x = np.concatenate([centres, centres.repeat(6, axis=0) + 0.22 * rng.standard_normal((6 * (n // 8), dim))])
    return np.concatenate([x, x[:5], 3 * x[5:9]]).astype(np.float32)


@pytest.mark.parametrize("dim,block", [(16, 32), (3, 512)])
def test_similarity_join_equals_brute_force(spark, dim, block):
    x = vectors(np.random.default_rng(1), 240, dim)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * dim, 0), (903, [float("nan")] + [1.0] * (dim - 1), 0), (904, [float("inf")] * dim, 0),
           (905, [None] + [1.0] * (dim - 1), 0), (906, [1.0], 0), (None, [1.0] * dim, 0)]
    df = spark.createDataFrame(rows + odd, VECS).withColumn("rep", F.lit("clash"))
    got = {r["vec_id"]: r for r in egojoin.similarity_join(df, block=block).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.minimum(label, np.where(link, label[None, :], 1 << 30).min(axis=1))
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(axis=1).tolist() and link.sum() > 100
    assert [got[i]["component_id"] for i in range(len(x))] == label.tolist()
    assert all(got[i]["kept"] == (label[i] == i) for i in range(len(x)))
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in range(900, 907)) and not got[None]["kept"]
    assert egojoin.similarity_join(df.limit(0)).count() == 0


def test_similarity_join_of_several_lengths(spark):
    rng = np.random.default_rng(5)
    parts = [(d, rng.normal(size=(6, d)).repeat(n, axis=0) + rng.normal(size=(6 * n, d)) * 0.1) for d, n in ((5, 4), (12, 7), (1, 1))]
    rows = [(i, v.astype(np.float32).tolist(), None) for i, v in enumerate(v for _, m in parts for v in m)] + [(500, None, 1), (501, [0.0] * 5, 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in egojoin.similarity_join(spark.createDataFrame(rows, VECS)).collect()}
    sound = [(i, np.array(v) / np.linalg.norm(v)) for i, v, _ in rows if v is not None and any(v)]
    near = {i: {j for j, w in sound if j != i and len(w) == len(v) and v @ w >= 0.9} for i, v in sound}
    label = {i: i for i, _ in sound}
    for _ in sound:
        label = {i: min([label[i], *(label[j] for j in near[i])]) for i in label}
    want = {i: (len(near[i]), label[i], label[i] == i) for i in label} | {500: (0, 500, True), 501: (0, 501, True)}
    assert got == want and sum(n for n, _, _ in got.values()) > 100


def test_similarity_join_stores_no_vector_for_each_partner(spark, monkeypatch):
    rng = np.random.default_rng(8)
    crowd = rng.standard_normal(16) + 0.01 * rng.standard_normal((400, 16))
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(np.concatenate([crowd, rng.standard_normal((200, 16))]))]
    seen, settle = {}, egojoin.table

    def spy(df, name):
        out = settle(df, name)
        seen[name] = df._jdf.queryExecution().executedPlan().toString(), out.count()
        return out

    monkeypatch.setattr(egojoin, "table", spy)
    got = {r["vec_id"]: r for r in egojoin.similarity_join(spark.createDataFrame(rows, VECS), block=4).collect()}
    plan, found = seen["found"]
    assert "Exchange" not in plan  # no shuffle or broadcast of vectors, however many tiles a tile meets
    assert found < 20 * len(rows)  # 5,050 pairs of blocks in the crowd alone
    assert all(got[i]["n_links"] >= 399 and got[i]["component_id"] == 0 for i in range(400))


def test_similarity_join_of_wide_vectors(spark, monkeypatch):
    x = vectors(np.random.default_rng(4), 160, 600)
    df = spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)], VECS)
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    sizes, settle = [], egojoin.table

    def spy(df, name):
        out = settle(df, name)
        if name == "tiles":
            sizes.extend(r[0] for r in out.select(F.length("vectors")).collect())
        return out

    monkeypatch.setattr(egojoin, "table", spy)
    monkeypatch.setattr(egojoin, "TILE_NUMBERS", 20000)  # one block of 32, no second one
    got = {r["vec_id"]: r["n_links"] for r in egojoin.similarity_join(df, block=32).collect()}
    assert [got[i] for i in range(len(x))] == link.sum(axis=1).tolist() and link.any()
    assert len(sizes) > 4 and max(sizes) <= 32 * 600 * 4


def test_similarity_join_at_the_threshold(spark):
    steps = [s * 10.0 ** -e for e in (3, 5, 6, 7, 8, 10, 12) for s in (1, -1)]
    at = np.zeros((len(steps) + 1, len(steps) + 1))
    at[0, 0] = 1
    for i, step in enumerate(steps, 1):
        at[i, 0] = 0.9 + step
        at[i, i] = np.sqrt(1 - at[i, 0] ** 2)
    df = spark.createDataFrame([(i, [float(x) for x in v * (i + 1)]) for i, v in enumerate(at)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in egojoin.similarity_join(df).collect()}
    assert got == {0: len(steps) // 2} | {i: int(step > 0) for i, step in enumerate(steps, 1)}


def test_nearest_recall_order_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1200, 24)) * rng.uniform(0.5, 2, (1200, 1))
    x[40] = x[41]
    x = x.astype(np.float32)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(2000, None, 0), (2020, [0.0] * 24, 0), (2040, [float("nan")] * 24, 0), (2060, [1.0], 0), (None, [1.0] * 24, 0), rows[41]]
    df = spark.createDataFrame(rows + odd, VECS).withColumn("score", F.lit("clash"))
    got = collision.nearest(df, shard=500, block=20).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(by) == list(range(0, 1200, 20)) and all(len(v) == 20 for v in by.values())
    d, hit = x.astype(np.float64), 0
    for q, found in by.items():
        s = (d * d[q]).sum(axis=1)
        assert q not in dict(found) and np.allclose([s[i] for i, _ in found], [v for _, v in found], rtol=1e-12)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        s[q] = -np.inf
        hit += len(set(np.argsort(-s, kind="stable")[:20]) & set(dict(found)))
    assert hit / (20 * len(by)) >= 0.9
    few = spark.createDataFrame(rows[:5], VECS)
    assert [r["rank"] for r in collision.nearest(few).orderBy("rank").collect()] == [1, 2, 3, 4]
    assert collision.nearest(few.limit(0)).count() == 0


def test_nearest_keeps_vectors_of_two_lengths_apart(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.standard_normal(8 if i % 3 else 12)], 0) for i in range(900)]
    got = {}
    for r in collision.nearest(spark.createDataFrame(rows, VECS), shard=200, block=16).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hit = n = 0
    for q, v, _ in rows[::20]:
        own = sorted(((-float(np.dot(v, x)), i) for i, x, _ in rows if len(x) == len(v) and i != q))[:20]
        hit, n = hit + len(set(got[q]) & {i for _, i in own}), n + len(own)
        assert len(got[q]) == 20 and all(len(rows[i][1]) == len(v) for i in got[q])
    assert hit / n >= 0.9
