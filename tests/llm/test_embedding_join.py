import numpy as np

from judgeset.llm.embedding_join import SIDE, near_duplicate_vectors, op3_embedding_join, squares


def brute_force(rows, cosine=0.93):
    ids = [i for i, *_ in rows]
    links, root = dict.fromkeys(ids, 0), {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_label = {}
    for i, v, label in rows:
        if label is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        by_label.setdefault((label, len(v)), []).append((i, np.array(v, np.float64)))
    for group in by_label.values():
        u = np.array([v / np.abs(v).max() for _, v in group])
        u = u / np.sqrt((u * u).sum(axis=1, keepdims=True))
        for a, b in np.argwhere(np.triu(u @ u.T >= cosine, 1)):
            i, j = group[a][0], group[b][0]
            links[i], links[j] = links[i] + 1, links[j] + 1
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), find(i) == i) for i in ids}


def check(df):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(df).collect()}
    assert got == brute_force(rows)


def test_embeddings_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in op3_embedding_join(spark, "/root/testdata/sf0.01").collect()}
    assert got == brute_force(rows)


def test_dense_groups_over_many_blocks(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(1500):
        c = centres[0] if i < 500 else centres[rng.integers(6)]
        noise = 0.15 if i % 3 else 0.0
        rows.append((i, (c * rng.uniform(0.5, 2) + noise * rng.normal(size=12)).tolist(), int(i % 2)))
    rows += [(2000 + k, rows[k][1], rows[k][2]) for k in range(40)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0), (5, [1.0, 0.0], None), (6, [1.0, 0.0], 0), (7, [2.0, 0.0], 0), (8, [1.0, 0.0, 0.0], 0), (9, [], 0), (10, [float("inf"), 1.0], 0), (11, [1.0, 0.1], 0)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<double>, label int, rep int")
    check(df)
    assert near_duplicate_vectors(df.limit(0)).count() == 0
    extra = near_duplicate_vectors(df.unionByName(spark.createDataFrame([(None, [1.0, 0.0], 0, 1)], df.schema))).filter("vec_id IS NULL").collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in extra] == [(0, None, False)]


def test_huge_and_tiny_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist(), 0) for i in range(300)]
    rows += [(1000, [1e200, 1.0, 0.0], 0), (1001, [1e200, 2.0, 0.0], 0), (1002, [1e-170, 1e-171, 0.0], 0), (1003, [1e300, 1e299, 0.0], 0), (1004, [5e-324, 0.0, 0.0], 0), (1005, [0.0, 1.7e308, 1.7e308], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    check(df)
    links = {r["vec_id"]: r["n_links"] for r in near_duplicate_vectors(df).collect()}
    assert all(links[i] >= 4 for i in range(1000, 1005))


def test_long_vectors_in_small_blocks(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 600))
    rows = [(i, (base[i % 20] + 0.2 * rng.normal(size=600)).tolist(), 0) for i in range(500)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))


def test_blocks_are_sent_once_a_square(spark):
    pairs = spark.range(40).selectExpr("'x' AS label", "3 AS size", "id AS a").join(spark.range(40).selectExpr("id AS b")).filter("a <= b")
    rows = squares(pairs).collect()
    assert {(r["id"], b) for r in rows for b in r["partners"]} == {(a, b) for a in range(40) for b in range(a, 40)}
    n = 40 // SIDE
    assert len(rows) == n * (n - 1) // 2 * 2 * SIDE + n * SIDE and len({(r["ta"], r["tb"], r["id"]) for r in rows}) == len(rows)
    assert max(len(r["partners"]) for r in rows) <= SIDE


def test_many_squares(spark, monkeypatch):
    """Blocks of eight vectors: hundreds of blocks a label, links across squares."""
    from judgeset.llm import embedding_join

    monkeypatch.setattr(embedding_join, "BLOCK_BYTES", 1)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(90, 6))
    rows = [(i, (base[i % 90] + 0.12 * rng.normal(size=6)).tolist(), int(i % 7 == 0)) for i in range(1600)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
