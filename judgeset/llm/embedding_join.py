"""Embedding near-dedup by an epsilon grid order join: sorted blocks of vectors, joined interval by interval."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.llm._components import components
from judgeset.llm._tables import Scratch, table, tidy

#: Grid cells are kept on so many leading principal dimensions, bounding boxes on so many, found among so many candidates.
CELLS, BOXES, CANDIDATES = 6, 16, 32
#: Vectors in a block, and bytes at most; blocks or intervals in the next larger interval.
BLOCK, BLOCK_BYTES, FAN = 512, 1 << 20, 4
#: Pairs of blocks are compared in squares of so many neighbouring blocks a side; a block is sent once a square.
SIDE = 8


def _units(raw: np.ndarray) -> np.ndarray:
    """Unit vectors. Scaled by the largest component first, so that no square over- or underflows."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable(v) -> bool:
    if v is None or len(v) == 0:
        return False
    x = np.array([np.nan if y is None else y for y in v], np.float64)
    return bool(np.isfinite(x).all() and (x != 0).any())


def _clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch = batch[np.array([_usable(v) for v in batch["embedding"]], bool)]
        yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "size": [len(v) for v in batch["embedding"]], "raw": [np.asarray(v, "<f8").tobytes() for v in batch["embedding"]]})


def _summed(vectors: DataFrame, of) -> dict[int, np.ndarray]:
    """The sum of of(unit vectors, their size) over all vectors, for each vector size."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, part in batch.groupby("size"):
                total[d] = total.get(d, 0) + of(_units(np.frombuffer(b"".join(part["raw"]), "<f8").reshape(len(part), d)), int(d))
        if total:
            yield pd.DataFrame({"size": list(total), "sums": [s.tolist() for s in total.values()]})

    rows = vectors.select("size", "raw").mapInPandas(tidy(sums), "size int, sums array<double>").select("size", F.posexplode("sums")).groupBy("size", "pos").agg(F.sum("col").alias("x"))
    return {int(d): part.sort_values("pos")["x"].to_numpy() for d, part in rows.toPandas().groupby("size")}


def _directions(d: int) -> np.ndarray:
    return np.eye(d) if d <= CANDIDATES else np.random.default_rng(d).normal(size=(d, CANDIDATES))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Up to BOXES leading axes of each vector size, by falling variance, from a randomised range finder: one pass for
    the covariance's image of some directions, one for the covariance inside that image. Any orthonormal axes would
    give right results; size * CANDIDATES numbers of each vector size are all that reaches the driver."""
    image = _summed(vectors, lambda u, d: np.hstack([(u.T @ (u @ _directions(d))).ravel(), u.sum(axis=0), [len(u)]]))
    bases = {}
    for d, x in image.items():
        w = _directions(d)
        mean = x[-1 - d : -1] / x[-1]
        bases[d] = np.linalg.qr(x[: d * w.shape[1]].reshape(d, -1) / x[-1] - np.outer(mean, mean @ w))[0]
    shared = vectors.sparkSession.sparkContext.broadcast(bases)
    inside = _summed(vectors, lambda u, d: np.hstack([((z := u @ shared.value[d]).T @ z).ravel(), z.sum(axis=0), [len(u)]]))
    axes = {}
    for d, x in inside.items():
        k = bases[d].shape[1]
        mean = x[-1 - k : -1] / x[-1]
        axes[d] = (bases[d] @ np.linalg.eigh(x[: k * k].reshape(k, k) / x[-1] - np.outer(mean, mean))[1][:, ::-1])[:, :BOXES].copy()
    return axes


def squares(pairs: DataFrame) -> DataFrame:
    """From pairs of blocks (label, size, a, b): the blocks (id) that each square of pairs (ta, tb) needs, and the larger
    blocks of the same square that each is compared with (partners, SIDE at most)."""
    roles = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("partner")), F.struct(F.col("b").alias("id"), F.lit(None).cast("long").alias("partner")))
    square = [F.floor(F.col(c) / SIDE).alias(f"t{c}") for c in ("a", "b")]
    return pairs.select("label", "size", *square, F.explode(roles).alias("x")).groupBy("label", "size", "ta", "tb", "x.id").agg(F.collect_list("x.partner").alias("partners"))


def near_duplicate_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row: links join vectors of one label with cosine >= cosine.

    Equal vectors are one representative with a weight. Representatives are sorted by label and by their grid cells
    (side eps, the chord of the angle) on the leading principal axes, and cut into blocks. Blocks form intervals, and
    those larger ones up to one per label. Starting there, each pair of intervals is replaced by the pairs of its parts
    unless their bounding boxes are further apart than eps; the pairs of blocks left over are compared as matrices, in
    squares of SIDE by SIDE neighbouring blocks, to which each block is sent once. A pair of blocks yields link counts and one edge per linked vector, never its pairs.

    Rows with a null label, and vectors that are null, empty, all zero or hold null or non-finite numbers, link with
    nothing; vectors of different sizes neither. Finite numbers of any size count. A null id takes part in no link (component null, kept false). Rows
    that repeat an id share its links. Other columns are not read. An empty table gives no rows.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "embedding")
    eps = float(np.sqrt(2 - 2 * cosine))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("embedding"))
    clean = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").mapInPandas(tidy(_clean), "vec_id long, label string, size int, raw binary")
    clean = scratch.keep(clean.select("*", F.xxhash64("raw").alias("h1"), F.xxhash64(F.lit(7), "raw").alias("h2")), "vectors")
    same = ["label", "size", "h1", "h2"]
    reps = scratch.keep(clean.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("weight"), F.min("raw").alias("raw")), "representatives")
    axes = spark.sparkContext.broadcast(principal_axes(reps))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, part in batch.groupby("size"):
                at = _units(np.frombuffer(b"".join(part["raw"]), "<f8").reshape(len(part), d)) @ axes.value[d][:, :CELLS]
                grid = np.zeros((len(part), CELLS), np.int32)
                grid[:, : at.shape[1]] = np.floor(at / eps)
                yield pd.DataFrame({"label": part["label"], "size": part["size"], "rep": part["rep"], "weight": part["weight"], "raw": part["raw"]} | {f"g{i}": grid[:, i] for i in range(CELLS)})

    order = ["label", "size", *[f"g{i}" for i in range(CELLS)], "rep"]
    gridded = reps.select("label", "size", "rep", "weight", "raw").mapInPandas(tidy(cells), "label string, size int, rep long, weight long, raw binary, " + ", ".join(f"g{i} int" for i in range(CELLS)))

    def block(rows_: list[pd.DataFrame], number: int) -> pd.DataFrame:
        part = pd.concat(rows_)
        d = int(part["size"].iloc[0])
        raw = b"".join(part["raw"])
        at = _units(np.frombuffer(raw, "<f8").reshape(len(part), d)) @ axes.value[d][:, :BOXES]
        from pyspark import TaskContext

        return pd.DataFrame([{"label": part["label"].iloc[0], "size": d, "part": TaskContext.get().partitionId(), "number": number, "reps": part["rep"].tolist(), "weights": part["weight"].tolist(), "raw": raw, "lo": (at.min(axis=0) - 1e-9).tolist(), "hi": (at.max(axis=0) + 1e-9).tolist()}])

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, key, number = [], 0, None, 0
        for batch in batches:
            for mine, run in batch.groupby(["label", "size"], sort=False):
                if mine != key and n:
                    yield block(held, number)
                    held, n = [], 0
                if mine != key:
                    key, number = mine, 0
                most = max(8, min(BLOCK, BLOCK_BYTES // (8 * int(mine[1]))))
                while len(run):
                    take = run.iloc[: most - n]
                    held, n, run = [*held, take], n + len(take), run.iloc[len(take) :]
                    if n == most:
                        yield block(held, number)
                        held, n, number = [], 0, number + 1
        if n:
            yield block(held, number)

    shape = "label string, size int, part int, number int, reps array<long>, weights array<long>, raw binary, lo array<double>, hi array<double>"
    placed = scratch.keep(gridded.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(tidy(blocks), shape), "blocks")
    per = placed.groupBy("label", "size", "part").count()
    before = per.select("label", "size", "part", (F.sum("count").over(W.partitionBy("label", "size").orderBy("part")) - F.col("count")).alias("before"))
    made = placed.join(before, ["label", "size", "part"]).withColumn("id", F.col("before") + F.col("number"))

    levels = [scratch.keep(made.select("label", "size", "id", "lo", "hi"), "level")]
    high = levels[0].agg(F.max("id")).first()[0]
    while high:
        dims = F.sequence(F.lit(0), F.size(F.element_at("los", 1)) - 1)
        up = levels[-1].groupBy("label", "size", F.floor(F.col("id") / FAN).alias("id")).agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
        up = up.select("label", "size", "id", F.transform(dims, lambda i: F.array_min(F.transform("los", lambda x: F.get(x, i)))).alias("lo"), F.transform(dims, lambda i: F.array_max(F.transform("his", lambda x: F.get(x, i)))).alias("hi"))
        levels.append(scratch.keep(up, "level"))
        high //= FAN
    spent = [placed, *levels]
    pairs = levels[-1].select("label", "size", F.col("id").alias("a"), F.col("id").alias("b"))
    gap = lambda i: F.greatest(F.lit(0.0), F.get("loa", i) - F.get("hib", i), F.get("lob", i) - F.get("hia", i))
    for level in levels[-2::-1]:
        left = level.select("label", "size", F.floor(F.col("id") / FAN).alias("a"), F.col("id").alias("ca"), F.col("lo").alias("loa"), F.col("hi").alias("hia"))
        right = level.select("label", "size", F.floor(F.col("id") / FAN).alias("b"), F.col("id").alias("cb"), F.col("lo").alias("lob"), F.col("hi").alias("hib"))
        parts = pairs.join(left, ["label", "size", "a"]).join(right, ["label", "size", "b"]).filter("ca <= cb")
        apart = F.aggregate(F.transform(F.sequence(F.lit(0), F.size("loa") - 1), lambda i: gap(i) * gap(i)), F.lit(0.0), lambda x, y: x + y)
        pairs = scratch.keep(parts.filter(apart <= eps * eps + 1e-9).select("label", "size", F.col("ca").alias("a"), F.col("cb").alias("b")), "pairs")
        spent.append(pairs)

    def compared(x, a: np.ndarray, y, b: np.ndarray) -> Iterator[pd.DataFrame]:
        link = a @ b.T >= cosine
        if x.id == y.id:
            np.fill_diagonal(link, False)
        if not link.any():
            return
        low_a, low_b = np.asarray(x.reps, np.int64), np.asarray(y.reps, np.int64)
        ids = np.concatenate([low_a, low_b])
        count_a, count_b = link @ np.asarray(y.weights, np.int64), link.T @ np.asarray(x.weights, np.int64)
        most = np.iinfo(np.int64).max
        while True:  # the smallest id that each vector reaches through links of this pair of blocks
            new_b = np.minimum(low_b, np.where(link, low_a[:, None], most).min(axis=0))
            new_a = np.minimum(low_a, np.where(link, new_b[None, :], most).min(axis=1))
            if x.id == y.id:
                new_a = new_b = np.minimum(new_a, new_b)
            if (new_a == low_a).all() and (new_b == low_b).all():
                break
            low_a, low_b = new_a, new_b
        counts = np.concatenate([count_a, np.zeros(len(b), np.int64) if x.id == y.id else count_b])
        some = counts > 0
        yield pd.DataFrame({"rep": ids[some], "links": counts[some], "low": np.concatenate([low_a, low_b])[some]})

    def square(held: list) -> Iterator[pd.DataFrame]:
        units = {x.id: _units(np.frombuffer(x.raw, "<f8").reshape(-1, x.size)) for x in held}
        by_id = {x.id: x for x in held}
        for x in held:
            for other in x.partners:
                yield from compared(x, units[x.id], by_id[other], units[other])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """From blocks sorted by square; holds the blocks of one square, 2 SIDE at most."""
        key, held = None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if (row.label, row.size, row.ta, row.tb) != key:
                    yield from square(held)
                    key, held = (row.label, row.size, row.ta, row.tb), []
                held.append(row)
        yield from square(held)

    needs = scratch.keep(squares(pairs), "squares")
    sent = needs.join(made.select("label", "size", "id", "reps", "weights", "raw"), ["label", "size", "id"])
    by = ["label", "size", "ta", "tb"]
    found = scratch.keep(sent.repartition(*by).sortWithinPartitions(*by).mapInPandas(tidy(compare), "rep long, links long, low long"), "found")
    scratch.drop(needs, *spent)
    group = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")), scratch)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = reps.select(*same, "rep", "weight").join(links, "rep", "left").join(group.withColumnRenamed("node", "rep"), "rep", "left")
    of_vector = clean.select("vec_id", *same).join(known, same).groupBy("vec_id").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = rows.select("vec_id").join(of_vector, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
