"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Vectors lie in blocks over the cluster. A block has one list for each component, sorted by its values; a query reads
the lists of its positive components from the top and those of its negative ones from the bottom, all to the same depth.
What has been read, with the least or the last read value in place of what hasn't, gives a lower and an upper bound
of every score. Rows whose upper bound is below the k-th lower bound are out; reading goes deeper until few rows are
left or the lists end, and the final scores of those rows are then added up in whole numbers. Bounds of a batch of
queries are computed together. The k-th score found so far is carried from block to block of a task.

The query set is written to the shared folder in chunks that all tasks map into memory, so there is no join.
A task emits at most k rows for each query, and the final cut keeps k of them.

Null vectors and vectors with null or non-finite components take no part, nor do rows without an id. Vectors of
different lengths aren't compared. A query is never compared with rows of its own id; repeated rows each count. Scores have to fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm import shared
from weftline.llm.registry import query, table

K = 5
BLOCK_ROWS = 4096
TASK_ROWS = 4 * BLOCK_ROWS
CHUNK = 256
#: Fractions of the lists that are read before looking at the bounds again.
DEPTHS = (1 / 8, 1 / 4, 1 / 2, 1)
#: So many rows are resolved at once instead of reading on.
RESOLVE = 64


def vectors_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, floor of 256 times the components) of the usable rows, for each length of vectors."""
    ids, vectors = batch.column(0), batch.column(1)
    usable = pc.and_(ids.is_valid(), vectors.is_valid())
    ids, vectors = ids.filter(usable), vectors.filter(usable)
    if not len(ids):
        return
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    values, ends = np.floor(256 * flat), np.cumsum(lengths)
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    good = bad[ends] == bad[ends - lengths]
    ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
    for length in np.unique(lengths[good]).tolist():
        own = np.flatnonzero(good & (lengths == length))
        yield ids[own], values[(ends - lengths)[own][:, None] + np.arange(length)].astype(np.int64)


class Block:
    """Rows with the places that each of them has in the sorted list of each component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        order = np.argsort(-values, axis=0, kind="stable")
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.broadcast_to(np.arange(len(ids))[:, None], order.shape), 0)
        self.sorted = np.take_along_axis(values, order, 0)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows that may be among its k best and their scores; ``floor`` has the k-th score known before."""
        n, size = self.values.shape
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(self.values).max(initial=0)) * max(size, 1) * 4
        kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else object
        if kind is object:  # bounds wouldn't be exact
            for i, q in enumerate(queries):
                own = np.flatnonzero(self.ids != query_ids[i])
                out[i] = own, (self.values[own].astype(object) @ q.astype(object)).astype(np.int64) if size else np.zeros(own.size, np.int64)
            return out
        values, low, high = self.values.astype(kind), self.sorted[-1].astype(kind), self.sorted[0].astype(kind)
        up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
        open_rows = np.arange(len(queries))
        for depth in DEPTHS:
            read = n if depth == 1 else max(1, int(n * depth))
            top, bottom = self.place < read, self.place >= n - read
            last_top, last_bottom = self.sorted[read - 1].astype(kind), self.sorted[n - read].astype(kind)
            p, q = up[open_rows], down[open_rows]
            lower = (p @ low + q @ high)[:, None] + p @ ((values - low) * top).T + q @ ((values - high) * bottom).T
            upper = (p @ last_top + q @ last_bottom)[:, None] + p @ ((values - last_top) * top).T + q @ ((values - last_bottom) * bottom).T
            own = query_ids[open_rows][:, None] == self.ids
            lower[own] = upper[own] = -np.inf
            kth = floor[open_rows]
            if n >= k:
                kth = np.maximum(kth, np.partition(lower, n - k, axis=1)[:, n - k])
            alive = (upper >= kth[:, None]) & ~own
            done = (alive.sum(1) <= RESOLVE) | (read == n)
            for i in np.flatnonzero(done).tolist():
                rows = np.flatnonzero(alive[i])
                out[open_rows[i]] = rows, self.values[rows] @ queries[open_rows[i]]
            open_rows = open_rows[~done]
            if not open_rows.size:
                break
        return out


def write_queries(df: DataFrame) -> tuple[str, list[str]]:
    """The distinct query rows (id, vector) of ``df`` in chunk files of one vector length each; (folder, names)."""
    folder = shared.new_folder(df.sparkSession, "queries")
    rows = df.distinct()
    parts = max(1, -(-rows.count() // (8 * CHUNK)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, held = TaskContext.get().partitionId(), [], {}

        def put(size: int) -> None:
            ids, values = (np.concatenate(x) for x in zip(*held.pop(size), strict=True))
            for at in range(0, len(ids), CHUNK):
                names.append(f"chunk-{part:06d}-{len(names):06d}")
                own = ids[at:at + CHUNK]
                shared.put(folder, names[-1], np.array([own.size, size], np.int64), own, values[at:at + CHUNK])

        for batch in batches:
            for ids, values in vectors_of(batch):
                held.setdefault(values.shape[1], []).append((ids, values))
                if sum(len(i) for i, _ in held[values.shape[1]]) >= 8 * CHUNK:
                    put(values.shape[1])
        for size in list(held):
            put(size)
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    return folder, sorted(r.name for r in rows.repartition(parts).mapInArrow(run, "name string").collect())


def search(vectors: DataFrame, queries: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of every query over all ``vectors``, ties to the smaller id."""
    def narrow(df: DataFrame) -> DataFrame:
        return df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{vector}`"].alias("vector"))

    folder, names = write_queries(narrow(queries))
    rows = narrow(vectors)
    parts = max(1, -(-rows.count() // TASK_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for ids, values in vectors_of(batch):
                held.setdefault(values.shape[1], []).append((ids, values))
        blocks: dict[int, list[Block]] = {}
        for size, parts_of in held.items():
            ids, values = (np.concatenate(x) for x in zip(*parts_of, strict=True))
            blocks[size] = [Block(ids[at:at + BLOCK_ROWS], values[at:at + BLOCK_ROWS]) for at in range(0, len(ids), BLOCK_ROWS)]
        for number, name in enumerate(names):
            raw = shared.mapped(folder, name)
            n, size = raw[:16].view(np.int64).tolist()
            ids, values = raw[16:16 + 8 * n].view(np.int64), raw[16 + 8 * n:].view(np.int64).reshape(n, size)
            floor, best = np.full(n, -np.inf), [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n
            for block in blocks.get(size, []):
                for i, (found, scores) in enumerate(block.search(ids, values, k, floor)):
                    vec, score = np.append(best[i][0], block.ids[found]), np.append(best[i][1], scores)
                    first = np.lexsort((vec, -score))[:k]
                    best[i] = vec[first], score[first]
                    if first.size == k:
                        floor[i] = score[first[-1]]
            counts = [len(b[0]) for b in best]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(number * CHUNK + np.arange(n), counts), pa.int64()), pa.array(np.repeat(ids, counts), pa.int64()),
                pa.array(np.concatenate([b[0] for b in best]), pa.int64()), pa.array(np.concatenate([b[1] for b in best]), pa.int64())],
                names=["query", "query_id", "vec_id", "score"])

    found = rows.repartition(parts).mapInArrow(run, "query long, query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query("op9_topk", _SQL)
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 50 = 0"))
