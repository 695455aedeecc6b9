import numpy as np
from trovespark.llm import hnsw


def brute(rows, k, every):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in {i for i, _ in good if i % every == 0}:
        near = {}
        for i, v in good:
            for j, w in good:
                if j == q and i != q and len(v) == len(w):
                    near[i] = min(near.get(i, np.inf), float(np.sqrt(((v - w) ** 2).sum())))
        out[q] = sorted((d, i) for i, d in near.items())[:k]
    return out


def clustered(rng, n, dim=32):
    centres = rng.normal(size=(12, dim)) * 3
    return centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim))


def test_graph_finds_the_nearest():
    rng = np.random.default_rng(0)
    vectors = clustered(rng, 3000)
    graph = hnsw.Graph.build(vectors, 1)
    hits = 0
    for q in range(0, 3000, 60):
        true = np.argsort(((vectors - vectors[q]) ** 2).sum(1), kind="stable")[:10]
        hits += len(set(true) & set(graph.search(vectors[q], 80)[:10]))
    assert hits / 500 > 0.97
    assert graph.neighbours[0].shape == (3000, hnsw.GROUND_LINKS) and (graph.neighbours[0] < 3000).all() and len(graph.nodes) > 1


def test_small_tables_are_exact_and_odd_rows_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(rng.choice(2000, 300, replace=False), clustered(rng, 300, 8))]
    rows += [(2100 + i, rows[0][1]) for i in range(60)] + [(2200, rows[0][1]), (2200, rows[0][1]), (2300, rows[5][1]), (2300, rows[9][1])]
    rows += [(3000, None), (3100, []), (3200, [0.0] * 8), (3300, [None] + [1.0] * 7), (3400, [float("nan")] * 8), (3500, [float("inf")] * 8), (None, rows[1][1]), (3600, [1.0, 2.0]), (3601, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as Embedding", "3 as rank")
    for size in (50, 1000):
        got = {}
        for r in hnsw.nearest(df, every=100, k=10, shard_rows=size).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.score, r.vec_id))
            assert r.rank == len(got[r.query_id])
        want = brute(rows, 10, 100)
        assert got.keys() == {q for q in want if want[q]}
        right = sum(i in [j for _, j in want[q]] for q in got for _, i in got[q])
        assert right / sum(map(len, want.values())) > 0.97
        for q in (2100, 2200, 3600):
            assert [i for _, i in got[q]] == [i for _, i in want[q]]
    assert hnsw.nearest(df.limit(0)).count() == 0


def test_recall_over_shards(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(rng, 4000, 24))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df, shard_rows=1500).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    vectors = np.array([v for _, v in rows])
    hits = sum(len(got[q] & set((np.argsort(((vectors - vectors[q]) ** 2).sum(1), kind="stable")[1:11]).tolist())) for q in range(0, 4000, 100))
    assert hits / 400 >= 0.95


def test_often_repeated_ids_hide_no_others(spark):
    rng = np.random.default_rng(4)
    spot = [1.0] * 8
    rows = [(0, spot)] * 15 + [(i, spot) for i in range(1, 6)]  # the query's own id is the smallest and fills a node
    rows += [(7, (np.ones(8) + 1e-3 * (j + 1) * np.eye(8)[j % 8]).tolist()) for j in range(400)]  # one id, many near vectors
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(clustered(rng, 300, 8))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r.vec_id for r in hnsw.nearest(df.where("vec_id % 100 != 0 or vec_id = 0"), k=10).where("query_id = 0").orderBy("rank").collect()]
    want = [i for _, i in brute([r for r in rows if r[0] % 100 or not r[0]], 10, 100)[0]]
    assert got == want and len(set(got)) == 10
