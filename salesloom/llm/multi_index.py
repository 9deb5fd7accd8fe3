"""Approximate nearest neighbours (operator 6): an inverted multi-index.

Vectors are scaled to length one, so the nearest by angle are the nearest by distance, and cut into two halves. Each half has
its own codebook (k-means on a bounded sample); a vector's cell is the pair of its nearest centroids, and every vector
is in the index. A query walks the pairs of centroids in the order of summed distance with a heap, until the cells it has
met hold enough vectors (fewer vectors: all cells). What is enough is measured: TUNING_QUERIES sampled vectors are compared with all
rows, and the budget is the least that reaches TARGET of their true neighbours. Each cell's vectors meet the queries that chose it as blocks of
bounded size, in numpy; the nearest of every block are merged per query, and scores are cosines in double
precision of the original vectors.

Equal vectors: only the NEIGHBOURS + 1 smallest ids of a vector can be among the nearest, so the others are not compared.
This is exact. Equal query vectors are searched once.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite numbers take no part; ties go
to the smaller id; repeated rows of one id and vector count once; queries without a partner give no row; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import written

# Centroids of a half: so many that a cell holds CELL_VECTORS on average, within these bounds.
CELL_VECTORS = 400
LEAST_CENTROIDS, MOST_CENTROIDS = 8, 256
SAMPLE = 20_000
STEPS = 12
TUNING_QUERIES = 64
TARGET = 0.97
LEAST_CANDIDATES = 500
NEIGHBOURS = 5
BLOCK_VECTORS = 4_096
BLOCK_QUERIES = 512
SEED = 5


def usable(table: DataFrame) -> DataFrame:
    """vec_id, vector (double) and key (equal for equal vectors) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    # -0.0 and 0.0 are one number.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    usual = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "size").first()
    if usual is not None:
        rows = rows.filter(F.size("vector") == usual["size"])
    return rows.withColumn("key", F.sha2(F.array_join(F.transform("vector", lambda x: x.cast("string")), ","), 256)).dropDuplicates(["vec_id", "key"])


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by the largest number, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(axis=1)


def codebook(points: np.ndarray, size: int) -> np.ndarray:
    """k-means of a sample."""
    random = np.random.default_rng(SEED)
    distinct = np.unique(points, axis=0)
    centroids = distinct[random.permutation(len(distinct))[:size]]
    for _ in range(STEPS):
        nearest = _distances(points, centroids).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = vectors.shape[1] // 2
    return vectors[:, :cut], vectors[:, cut:]


def nearest_cells(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells (pairs of centroids) by summed distance, until they hold `wanted` vectors; empty cells are passed over."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    agenda, pushed = [(first[rows[0]] + second[columns[0]], 0, 0)], {(0, 0)}
    cells, held = [], 0
    while agenda and held < wanted:
        _, i, j = heapq.heappop(agenda)
        cell = int(rows[i]) * len(columns) + int(columns[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(rows) and b < len(columns) and (a, b) not in pushed:
                pushed.add((a, b))
                heapq.heappush(agenda, (first[rows[a]] + second[columns[b]], a, b))
    return cells


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def _assigner(books):
    @F.arrow_udf("int")
    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        first, second = books.value
        for batch in batches:
            if not len(batch):
                yield pa.array([], pa.int32())
                continue
            a, b = halves(unit(_matrix(batch)))
            cell = _distances(a, first).argmin(axis=1) * len(second) + _distances(b, second).argmin(axis=1)
            yield pa.array(cell, pa.int32())

    return assign


def _traverser(books, sizes, wanted: int):
    @F.arrow_udf("array<int>")
    def traverse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        first, second = books.value
        for batch in batches:
            if not len(batch):
                yield pa.array([], pa.list_(pa.int32()))
                continue
            a, b = halves(unit(_matrix(batch)))
            distances = zip(_distances(a, first), _distances(b, second))
            yield pa.array([nearest_cells(x, y, sizes.value, wanted) for x, y in distances], pa.list_(pa.int32()))

    return traverse


def _sampled_neighbours(queries):
    """The nearest of a task's vectors to each sampled query."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ids, cells = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            scores = queries.value @ unit(_matrix(batch.column(1))).T
            best = np.argsort(-scores, axis=1)[:, : NEIGHBOURS + 1]
            count = best.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(scores)), count), pa.int32()),
                    pa.array(ids[best].reshape(-1), pa.int64()),
                    pa.array(cells[best].reshape(-1), pa.int32()),
                    pa.array(np.take_along_axis(scores, best, axis=1).reshape(-1), pa.float64()),
                ],
                ["query", "vec_id", "cell", "score"],
            )

    return compare


def measured_budget(index: DataFrame, books, sizes: np.ndarray, sample: pd.DataFrame) -> int:
    """Vectors a query must meet so that TARGET of the sampled queries' true neighbours are among them."""
    spark = index.sparkSession
    chosen = sample.iloc[:TUNING_QUERIES]
    points = unit(np.stack(chosen["vector"].to_list()))
    found = index.select("vec_id", "vector", "cell").mapInArrow(
        _sampled_neighbours(spark.sparkContext.broadcast(points)), "query int, vec_id bigint, cell int, score double"
    )
    own = spark.createDataFrame([(k, int(v)) for k, v in enumerate(chosen["vec_id"])], "query int, own bigint")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    others = found.join(F.broadcast(own), "query").filter("vec_id <> own").withColumn("place", F.row_number().over(order))
    needed = []
    walks: dict[int, dict[int, int]] = {}
    a, b = (_distances(h, book) for h, book in zip(halves(points), books.value))
    for row in others.filter(F.col("place") <= NEIGHBOURS).select("query", "cell").collect():
        if row["query"] not in walks:
            cells = nearest_cells(a[row["query"]], b[row["query"]], sizes, int(sizes.sum()) + 1)
            walks[row["query"]] = dict(zip(cells, (np.cumsum(sizes[cells]) - sizes[cells] + 1).tolist()))
        needed.append(walks[row["query"]][row["cell"]])
    return max(LEAST_CANDIDATES, int(np.quantile(needed, TARGET))) if needed else LEAST_CANDIDATES


def _compare(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The nearest of a block of vectors to each of a block of queries."""
    columns = ["query_key", "vec_id", "score"]
    if not len(vectors) or not len(queries):
        return pd.DataFrame({c: [] for c in columns}).astype({"query_key": "str", "vec_id": "int64", "score": "float64"})
    ids = vectors["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], unit(np.stack(vectors["vector"].to_list())[order].astype(np.float64))
    q = unit(np.stack(queries["query"].to_list()).astype(np.float64))
    # Plain sums over the components: the same for a pair in whichever block it meets.
    scores = np.einsum("qd,vd->qv", q, v, optimize=False)
    # Ids ascend, so a stable order gives ties to the smaller id. One more than asked: the query itself may be among them.
    best = np.argsort(-scores, axis=1, kind="stable")[:, : NEIGHBOURS + 1]
    near = np.clip(np.take_along_axis(scores, best, axis=1), -1.0, 1.0)
    keys = np.repeat(queries["query_key"].to_numpy(), best.shape[1])
    return pd.DataFrame({"query_key": keys, "vec_id": ids[best].reshape(-1), "score": near.reshape(-1)})


def search(table: DataFrame, is_query: Column) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for every row that is_query picks, against all rows."""
    spark = table.sparkSession
    rows = written(usable(table), "ann-rows")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "vector").toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = int(min(MOST_CENTROIDS, max(LEAST_CENTROIDS, (rows.count() / CELL_VECTORS) ** 0.5)))
    points = unit(np.stack(sample["vector"].to_list()))
    books = spark.sparkContext.broadcast(tuple(codebook(h, size) for h in halves(points)))
    smallest = Window.partitionBy("key").orderBy("vec_id")
    compared = rows.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= NEIGHBOURS + 1)
    index = written(compared.select("vec_id", "vector", _assigner(books)(F.col("vector")).alias("cell")), "ann-index")
    # One count per cell, and there are MOST_CENTROIDS squared cells at most.
    counts = index.groupBy("cell").agg(F.count("*").alias("n")).collect()
    sizes = np.zeros(len(books.value[0]) * len(books.value[1]), np.int64)
    for row in counts:
        sizes[row["cell"]] = row["n"]
    asked = rows.filter(is_query)
    distinct = asked.groupBy(F.col("key").alias("query_key")).agg(F.first("vector").alias("query"))
    wanted = measured_budget(index, books, sizes, sample)
    cells = _traverser(books, spark.sparkContext.broadcast(sizes), wanted)(F.col("query"))
    chosen = distinct.withColumn("cell", F.explode(cells))
    # Blocks of bounded size on both sides; a query goes to every block of a cell's vectors.
    blocks = spark.createDataFrame([(c, -(-int(n) // BLOCK_VECTORS)) for c, n in enumerate(sizes) if n], "cell int, blocks int")
    blocks = F.broadcast(blocks)
    query_blocks = max(1, -(-chosen.count() // (BLOCK_QUERIES * max(1, len(counts)))))
    place = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    vectors = index.join(blocks, "cell").withColumn("block", place).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    queries = chosen.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "part", F.pmod(F.xxhash64("query_key"), F.lit(query_blocks)).cast("int")
    )
    keys = ["cell", "block", "part"]
    near = vectors.select(*keys, "vec_id", "vector").groupBy(*keys).cogroup(
        queries.select(*keys, "query_key", "query").groupBy(*keys)
    ).applyInPandas(_compare, "query_key string, vec_id bigint, score double")
    best = Window.partitionBy("query_key").orderBy(F.col("score").desc(), "vec_id")
    near = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= NEIGHBOURS + 1).drop("place")
    pairs = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query_key")).join(near, "query_key")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = pairs.filter(F.col("query_id") != F.col("vec_id")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= NEIGHBOURS).select("query_id", "rank", "vec_id", "score")
