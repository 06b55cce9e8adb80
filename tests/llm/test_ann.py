import numpy as np
import pytest

from basketflow.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, k=20):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = (x * x[q]).sum(axis=1)
        others = np.flatnonzero(ids != ids[q])
        out[ids[q]] = sorted((-score[o], ids[o]) for o in others)[:k]
    return out


def results(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    want = brute(np.array([r.vec_id for r in rows]),
                 np.array([r.embedding for r in rows], np.float64))
    got = results(ann.nearest(df))
    assert set(got) == set(want)
    hit = sum(len({v for _, v, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(found, found[1:]))


def recall(spark, x, every=20):
    ids = np.arange(len(x))
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    got = results(ann.nearest(df))
    want = brute(ids, x.astype(np.float64))
    hit = sum(len({v for _, v, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    return hit / sum(map(len, want.values()))


def directions(rows):
    """Unit vectors without clusters: nothing lies much nearer than the rest."""
    x = np.random.default_rng(5).normal(size=(rows, 64))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def test_recall_with_many_lists(spark, monkeypatch):
    """Hundreds of lists, of which a fixed few hold too little."""
    monkeypatch.setattr(ann, "LIST_ROWS", 5)
    assert recall(spark, directions(5000)) >= 0.9


def test_queries_read_the_lists_of_long_vectors(spark):
    """A short query's best inner products lie far from it, in the lists of long vectors."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 64))[np.arange(4000) % 40] + 0.5 * rng.normal(size=(4000, 64))
    x *= (rng.lognormal(0, 0.5, 4000) / np.linalg.norm(x, axis=1))[:, None]
    index = ann.fit(ann.usable(spark.createDataFrame(
        [(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)), 40_000, 64,
        float(np.linalg.norm(x, axis=1).max()))
    order = index.nearest_first(0.1 * x[::100])
    owner = np.argmin((index.centroids ** 2).sum(axis=1)
                      - 2 * index.lengthen(x) @ index.centroids.T, axis=1)
    best = np.argsort(-x[::100] @ x.T, axis=1)[:, :20]
    read = order[:, :len(index.centroids) // 4]
    assert np.mean([np.isin(owner[b], r).mean() for b, r in zip(best, read)]) >= 0.97


def test_recall_on_mixed_norms(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 10)
    x = np.random.default_rng(7).lognormal(0, 0.5, 5000)[:, None] * directions(5000)
    assert recall(spark, x) >= 0.9


def test_ties_and_long_vectors(spark):
    """Equal vectors give the smaller ids; long vectors win by inner product."""
    rows = [(k, [1.0, 0.0], 0) for k in range(300)] + [(1000, [0.0, 9.0], 0), (1001, [5.0, 0.0], 0)]
    got = results(ann.nearest(spark.createDataFrame(rows, SCHEMA), k=4))
    assert [v for _, v, _ in got[20]] == [1001, 0, 1, 2]
    assert [v for _, v, _ in got[0]] == [1001, 1, 2, 3]


def test_blocks_meet_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    want = brute(np.arange(200), x.astype(float), 5)
    got = results(ann.nearest(df, k=5))
    hit = sum(len({v for _, v, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_small_isolated_groups_get_whole_results(spark, monkeypatch):
    """A group with lists of its own holds fewer candidates than asked for."""
    monkeypatch.setattr(ann, "LIST_ROWS", 10)
    rng = np.random.default_rng(2)
    ways = np.eye(10)
    x = ways[np.arange(1000) % 9] + 0.01 * rng.normal(size=(1000, 10))
    x[975:990] = ways[9] + 0.001 * rng.normal(size=(15, 10))         # 980 is a query
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    want = brute(np.arange(1000), x, 20)
    got = results(ann.nearest(df))
    assert {len(f) for f in got.values()} == {20} and set(got) == set(want)
    assert [v for _, v, _ in got[980]][:14] == [i for _, i in want[980]][:14]     # its own group first


def test_one_vector_of_a_repeated_id_counts(spark):
    rows = [(1, [3.0, 0.0], 0), (1, [1.0, 5.0], 0), (1, [2.0, 9.0], 0), (20, [1.0, 1.0], 0), (3, [1.0, 0.0], 0)]
    for order in (rows, rows[::-1]):
        got = results(ann.nearest(spark.createDataFrame(order, SCHEMA).repartition(3)))
        assert [(v, s) for _, v, s in got[20]] == [(1, 6.0), (3, 1.0)]


def test_columns_named_as_inside(spark):
    frame = spark.createDataFrame([(k, [float(k), 1.0], 0) for k in range(1, 50)], SCHEMA)
    clash = frame.selectExpr("*", *[f"'x' AS {c}" for c in ("id", "v", "list", "rank", "d", "block", "got")])
    assert sorted(ann.nearest(clash).collect()) == sorted(ann.nearest(frame).collect())


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [2.0, 1.0], 1), (1, [2.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1),
            (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0], 1),
            (None, [1.0, 1.0], 1), (20, [1.0, 1.0], None), (40, [], 1)]
    got = results(ann.nearest(spark.createDataFrame(rows, SCHEMA)))
    assert {q: [v for _, v, _ in f] for q, f in got.items()} == {0: [1, 20], 20: [0, 1]}
    assert got[0][0][2] == pytest.approx(4.0)


def test_no_rows(spark):
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rounds_return_little_and_lose_nothing(spark, monkeypatch):
    """Blocks of later rounds return only what reaches the k-th best so far, and the result is that of
    one round over the same lists."""
    monkeypatch.setattr(ann, "LIST_ROWS", 20)
    x = directions(2000)
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    returned, once = [], ann._round
    monkeypatch.setattr(ann, "_round", lambda *a: returned.append(once(*a).persist()) or returned[-1])
    lists = []
    monkeypatch.setattr(ann, "lists_to_read", lambda rows, stored, index, *a: lists.append(
        len(index.centroids)) or lists[-1])
    got = results(ann.nearest(df))
    rows = sum(r.count() for r in returned)
    assert len(returned) > 2 and lists[0] >= 100
    assert rows < 0.25 * 100 * 20 * lists[0]                # k for every query and list
    want = brute(np.arange(2000), x.astype(np.float64))
    assert {q: [v for _, v, _ in f] for q, f in got.items()} == {
        q: [i for _, i in f] for q, f in want.items()}
    monkeypatch.setattr(ann, "WIDER", 10 ** 6)
    assert results(ann.nearest(df)) == got
