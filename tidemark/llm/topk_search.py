"""Exact search for the largest inner products by reading sorted lists, without random access.

Vectors are kept in blocks, and a block has a list for each component: its vectors in the order of
that component. A query reads all lists of a block from the end its own component asks for, all to
the same depth. After that depth each vector has a lower bound (what was read of it, and the worst
value of the lists for the rest) and an upper bound (the last value that was read, for the rest);
one that was met nowhere has the same upper bound with nothing read. The k-th largest lower bound
is a threshold. When no vector that was not met can reach it and few of the others can, reading
stops, and the final scores of these few are added up.

The threshold is carried from block to block within a task, and begins with the k-th best score in
one block, whatever the task. Queries are taken in blocks of ``ASKED``, which are broadcast one after another;
a task sends on ``k`` rows for each query.

Components are whole numbers held in doubles. Sums are exact as long as they stay below 2^53, which
is checked for each query and block; beyond that the block is added up in unbounded integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import read_table, tidied
from tidemark.session import scratch_path, settle

SCALE = 1024
FIRST = 10
EVERY = 100
#: Vectors of a block: their places have 16 bits.
BLOCK = 4096
#: Queries that are broadcast at a time.
ASKED = 1024
#: Reading goes on while more than this share of a block can still be among the best.
FEW = 1 / 16
#: Part of the lists that is read before the first look at the bounds.
BEGIN = 1 / 8
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are vectors of finite numbers, their components, scaled and floored; short ones are filled up with 0)."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(lengths, 0))
    odd = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    begins = ends - np.maximum(lengths, 0)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    kept = np.flatnonzero((lengths >= 0) & (odd[ends] == odd[begins]))
    width = int(lengths[kept].max()) if len(kept) else 0
    out = np.zeros((len(kept), width))
    inside = np.arange(width) < lengths[kept][:, None]
    out[inside] = scaled[(begins[kept][:, None] + np.arange(width))[inside]]
    return kept, np.nan_to_num(out, posinf=np.finfo(float).max, neginf=-np.finfo(float).max)


def vector_blocks(df: DataFrame, id_col: str, vector: str, rows: int) -> DataFrame:
    """(ids, n, parts, lists): blocks of up to ``rows`` vectors in the order of their ids, and for each component their places by its value."""
    narrow = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    id_type, id_sql = to_arrow_type(narrow.schema["id"].dataType), dict(narrow.dtypes)["id"]

    @tidied
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                kept, matrix = _matrix(piece.column(1))
                ids = piece.column(0).take(pa.array(kept))
                if not len(ids):
                    continue
                order = pc.sort_indices(ids).to_numpy()
                ids, matrix = ids.take(pa.array(order)), matrix[order]
                lists = np.argsort(matrix, axis=0, kind="stable").T.astype(np.uint16)
                small = np.abs(matrix).max(initial=0) < 1 << 31
                parts = matrix.astype(np.int32).tobytes() if small else matrix.tobytes()
                arrays = [
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.cast(id_type)), pa.array([len(ids)], pa.int64()),
                    pa.array([small]), pa.array([parts], pa.binary()), pa.array([lists.tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["ids", "n", "small", "parts", "lists"])

    return narrow.mapInArrow(blocks, f"ids array<{id_sql}>, n long, small boolean, parts binary, lists binary")


def _parts(small: bool, parts: bytes, n: int) -> np.ndarray:
    return np.frombuffer(parts, np.int32 if small else np.float64).astype(np.float64).reshape(n, -1)


class Lists:
    """The sorted lists of one block."""

    def __init__(self, matrix: np.ndarray, lists: np.ndarray):
        self.matrix, self.lists = matrix, lists
        self.values = np.take_along_axis(matrix.T, lists.astype(np.int64), axis=1)
        self.largest = float(np.abs(matrix).max(initial=0))

    def best(self, query: np.ndarray, k: int, least: float, banned: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(places, scores) of the ``k`` best vectors, none of them ``banned``, that reach ``least``; ties to the smaller place."""
        n, width = self.matrix.shape
        query = np.pad(query[:width], (0, max(0, width - len(query))))
        if not max(width, 1) * self.largest * float(np.abs(query).max(initial=0)) < EXACT:
            whole = [[int(x) for x in row] for row in np.concatenate([query[None], self.matrix])]
            scores = [min(MOST, max(LEAST, sum(a * b for a, b in zip(whole[0], row)))) for row in whole[1:]]
            ranked = sorted((-s, i) for i, s in enumerate(scores) if not banned[i] and s >= least)[:k]
            return np.array([i for _, i in ranked], np.int64), [-s for s, _ in ranked]
        left = self._qualified(query, k, least, banned)
        scores = self.matrix[left] @ query
        left, scores = left[scores >= least], scores[scores >= least]
        order = np.lexsort((left, -scores))[:k]
        return left[order], scores[order].astype(np.int64).tolist()

    def _qualified(self, query: np.ndarray, k: int, least: float, banned: np.ndarray) -> np.ndarray:
        """Places of the vectors that can be among the ``k`` best by the bounds at which reading stops."""
        n = len(self.matrix)
        down, up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        weight = np.concatenate([query[down], query[up]])[:, None]
        worst = np.concatenate([self.values[down, 0], self.values[up, -1]])[:, None] * weight
        depth = max(1, int(n * BEGIN))
        while depth < n:
            last = np.concatenate([self.values[down, n - depth], self.values[up, depth - 1]])[:, None] * weight
            unmet = last.sum()  # the upper bound of a vector that no list has shown yet
            if unmet < least or least == -np.inf:
                places = np.concatenate([self.lists[down, n - depth :], self.lists[up, :depth]]).ravel()
                read = np.concatenate([self.values[down, n - depth :], self.values[up, :depth]]) * weight
                upper = unmet + np.bincount(places, (read - last).ravel(), n)
                lower = worst.sum() + np.bincount(places, (read - worst).ravel(), n)
                lower[banned] = -np.inf
                if n > k:
                    least = max(least, np.partition(lower, n - k)[n - k])
                can = (upper >= least) & ~banned
                if unmet < least and can.sum() <= max(k, n * FEW):
                    return np.flatnonzero(can)
                depth += max(1, (n - depth) // 2)
            else:
                depth += max(1, n // 16)
        return np.flatnonzero(~banned)


def _search(blocks: DataFrame, query_ids: pa.Array, queries: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score): for each task the best ``k`` vectors of every query."""
    spark = blocks.sparkSession
    id_type, id_sql = query_ids.type, dict(blocks.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    shared = spark.sparkContext.broadcast((query_ids, queries, least))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, vectors, bounds = shared.value
        bounds, found = bounds.copy(), [[] for _ in range(len(vectors))]
        for batch in batches:
            for row in range(batch.num_rows):
                ids, n = batch.column(0)[row].values, batch.column(1)[row].as_py()
                matrix = _parts(batch.column(2)[row].as_py(), batch.column(3)[row].as_buffer(), n)
                block = Lists(matrix, np.frombuffer(batch.column(4)[row].as_buffer(), np.uint16).reshape(matrix.shape[1], n))
                coded = pc.dictionary_encode(ids)
                codes, own = coded.indices.to_numpy(), pc.fill_null(pc.index_in(ids_of, value_set=coded.dictionary), -1).to_numpy()
                for q, vector in enumerate(vectors):
                    places, scores = block.best(vector, k, bounds[q], codes == own[q])
                    if len(places):
                        found[q] += zip(scores, ids.take(pa.array(places)).to_pylist())
                        found[q].sort(key=lambda x: (-x[0], x[1]))
                        del found[q][k:]
                        if len(found[q]) == k:
                            bounds[q] = max(bounds[q], found[q][-1][0])
        for q, name in enumerate(ids_of.to_pylist()):
            if found[q]:
                arrays = [pa.array([name] * len(found[q]), id_type), pa.array([i for _, i in found[q]], id_type), pa.array([s for s, _ in found[q]], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    return blocks.select("ids", "n", "small", "parts", "lists").mapInArrow(run, f"query_id {id_sql}, vec_id {id_sql}, score long")


def exact_top_k(
    df: DataFrame, is_query: Column | None = None, id_col: str = "vec_id", vector: str = "embedding", k: int = FIRST, block: int = BLOCK, queries: int = ASKED
) -> DataFrame:
    """The ``k`` rows with the largest inner products for each query: query_id, rank (from 1), vec_id, score.

    Components are floor(1024 x). ``is_query`` chooses the queries (by default ids divisible by 100); candidates are all rows but
    those with the query's own id. Equal scores: the smaller id first. Vectors that are NULL or hold NULL or a number
    that is not finite take no part, as a query or otherwise, nor do rows without an id. Of vectors of different
    lengths the shorter counts as filled up with 0. A score beyond 64 bits is the largest or smallest of 64 bits.
    Rows with the same id all count as candidates; of several queries with one id the one with the largest vector, by the order
    of its components, is asked. A table without queries, and an empty one, give an empty result; other columns are not read.
    """
    spark = df.sparkSession
    chosen = (F.col(id_col) % EVERY == 0) if is_query is None else is_query
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = df.where(F.col(id_col).isNotNull() & finite)
    blocks = settle(vector_blocks(valid, id_col, vector, block).withColumn("block", F.monotonically_increasing_id()), "vector-blocks")
    asked = valid.where(chosen).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(vector).cast("array<double>")).alias("vector"))
    asked = settle(asked, "asked")
    asked = settle(vector_blocks(asked.repartition(max(1, -(-asked.count() // queries))), "id", "vector", queries), "queries")
    largest = blocks.agg(F.max_by("block", "n")).first()[0]
    id_type = to_arrow_type(blocks.schema["ids"].dataType.elementType)
    path, schema = scratch_path(spark, "best"), None
    for row in asked.select("ids", "n", "small", "parts").toLocalIterator():  # a block of at most ``queries`` at a time
        names, vectors = pa.array(row.ids, id_type), _parts(row.small, row.parts, row.n)
        scores: dict = {name: [] for name in row.ids}
        for found in _search(blocks.where(F.col("block") == largest), names, vectors, np.full(row.n, -np.inf), k).collect():  # ``k`` rows a query
            scores[found.query_id].append(found.score)
        least = np.array([min(scores[name]) if len(scores[name]) == k else -np.inf for name in row.ids])
        best = _search(blocks, names, vectors, least, k)
        schema = best.schema
        best.write.mode("append").parquet(path)
    if schema is None:
        kind = dict(blocks.dtypes)["ids"].removeprefix("array<").removesuffix(">")
        best = spark.createDataFrame([], f"query_id {kind}, vec_id {kind}, score long")
    else:
        best = spark.read.schema(schema).parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_threshold_search": op11_threshold_search}

ORACLE_SQL = {
    "op11_threshold_search": """
    WITH parts AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM parts AS q JOIN parts AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored QUALIFY rank <= 10"""
}
