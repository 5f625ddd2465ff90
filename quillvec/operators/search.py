"""Exact top-k similarity search: one query, many queries in one namespace, many queries in all namespaces."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.functions.scoring import FLUSH_ENTRIES, METRICS, ROW_BLOCK, LocalTopK, as_matrix
from quillvec.storage import checkpointed, sized

BROADCAST_BYTES = 128 * 1024 * 1024
#: Queries that go to every task; each holds its k best of every namespace there.
SENT_QUERIES = 4096
#: Queries and vectors that meet in one task, and bytes of either as doubles.
CELL_QUERIES, CELL_VECTORS, CELL_BYTES = 32_768, 131_072, 64 * 1024 * 1024
MOST_TASKS = 4000
MERGE_FAN_IN = 256


def top_k(vectors: DataFrame, query: Sequence[float], k: int = M.TOP_K, metric: str = "dot",
          namespace: str = M.DEFAULT_NAMESPACE) -> DataFrame:
    """The k best records of one namespace for one query vector."""
    q = np.asarray([query], dtype=np.float64)
    mine = vectors.filter(F.col("namespace") == namespace)
    return _local(mine, [(q, pa.array([0]))], "long", k, metric).select("id", "score") \
        .orderBy(F.desc("score"), "id").limit(k)


def search_namespace(vectors: DataFrame, queries: DataFrame, namespace: str, k: int = M.TOP_K,
                     metric: str = "dot", **options) -> DataFrame:
    """The k best records of one namespace for every query."""
    return search(vectors.filter(F.col("namespace") == namespace), queries, k, metric, **options)


def search(vectors: DataFrame, queries: DataFrame, k: int = M.TOP_K, metric: str = "dot",
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The k best records per query and namespace: ``qid, namespace, id, score, rank``.

    ``vectors`` has ``namespace, id, values``; ``queries`` has ``qid, qv``. A query meets the vectors of its own length;
    a query or vector that is NULL or empty, or holds a NULL, NaN or infinite element, has no part in any result
    and takes nothing from others. Up to ``SENT_QUERIES`` queries, of ``broadcast_bytes`` at most, go to every task: vectors
    are scored where they are read, and only local winners move, so the size of a namespace does not matter. More
    queries than that meet the vectors in cells, see ``_in_cells``.
    """
    spark, qid_type = vectors.sparkSession, _qid_type(queries)
    known = _known(queries, "qid")
    n, size = known.agg(F.count("*"), F.coalesce(F.sum(F.size("qv").cast("long")), F.lit(0)) * 8).first()
    if n <= SENT_QUERIES and size <= broadcast_bytes:
        winners = _local(vectors, _by_length(known.toArrow()), qid_type, k, metric)
    else:
        winners = _in_cells(vectors, known, F.lit(n), size / n, qid_type, k, metric)
    return _ranked(winners, k, spark.sparkContext.defaultParallelism)


def search_routed(vectors: DataFrame, queries: DataFrame, metric: str = "dot") -> DataFrame:
    """The best records of each query's own ``namespace``, as many as its own ``top_k``; both are columns of
    ``queries`` beside ``qid, qv``. A NULL namespace or ``top_k`` gives nothing. A query meets the vectors of its own
    namespace only."""
    spark = vectors.sparkSession
    most = queries.agg(F.max("top_k")).first()[0]
    wanted = queries.select("qid", "namespace", "top_k")
    if not most or most < 1:
        return spark.createDataFrame([], _schema(_qid_type(queries)) + ", rank long")
    known = _known(queries.filter("namespace IS NOT NULL AND top_k > 0"), "qid", "namespace")
    mean = known.agg(F.coalesce(F.avg(F.size("qv")), F.lit(1.0)) * 8).first()[0]
    winners = _in_cells(vectors, known, F.col("queries"), mean, _qid_type(queries), most, metric)
    return _ranked(winners, most, spark.sparkContext.defaultParallelism).join(wanted, ["qid", "namespace"]) \
        .filter("rank <= top_k").select("qid", "namespace", "id", "score", "rank")


def _known(queries: DataFrame, *columns: str) -> DataFrame:
    return queries.filter("size(qv) > 0").select(*columns, F.col("qv").cast("array<double>").alias("qv"))


def _in_cells(vectors: DataFrame, known: DataFrame, n_queries: Column, query_bytes: float, qid_type: str, k: int,
              metric: str) -> DataFrame:
    """Winners of each cell: a block of queries against a part of a namespace.

    Queries with a ``namespace`` meet that one, others all. A cell holds about ``CELL_QUERIES`` queries, or fewer long
    ones, and ``CELL_VECTORS`` vectors, so a task's memory follows neither table; the number of cells follows the product
    of both, as the work does. Only the k best of each query leave a cell.
    """
    _check(metric)
    routed = "namespace" in known.columns
    in_block = max(1, min(CELL_QUERIES, FLUSH_ENTRIES // k, int(CELL_BYTES // max(1, query_bytes))))
    rows = _candidates(vectors)
    sizes = rows.groupBy("namespace").agg(F.count("*").alias("n"), F.max(F.size("values")).alias("width"))
    if routed:
        sizes = sizes.join(known.groupBy("namespace").agg(F.count("*").alias("queries")), "namespace")
    in_part = F.least(F.lit(CELL_VECTORS), F.greatest(F.lit(1), F.floor(F.lit(CELL_BYTES) / (8 * F.col("width")))))
    sizes = checkpointed(sizes.filter("width > 0").select(
        "namespace", F.ceil(n_queries / in_block).alias("blocks"), F.ceil(F.col("n") / in_part).alias("parts")))
    cells = sizes.agg(F.coalesce(F.sum(F.col("blocks") * F.col("parts")), F.lit(0))).first()[0]
    tasks = max(1, min(2 * cells, MOST_TASKS))

    def dealt(rows: DataFrame, own: list[str], count: str, name: str, other_count: str, other: str) -> DataFrame:
        """Each row in one piece of its own side, for every piece of the other."""
        placed = rows.withColumn(name, F.pmod(F.xxhash64(*own), F.col(count))) \
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_count) - 1))).drop("blocks", "parts")
        # Both sides come from the same table, and a cogroup takes no columns of one origin.
        return placed.toDF(*placed.columns).repartition(tasks, "namespace", "block", "part")

    met = known.join(sized(sizes), "namespace") if routed else known.crossJoin(sized(sizes))
    left = dealt(met, ["qid", "qv"], "blocks", "block", "parts", "part")
    right = dealt(rows.join(sized(sizes), "namespace"), ["id", "values"], "parts", "part", "blocks", "block")

    def score(asked: pa.Table, table: pa.Table) -> pa.Table:
        found = [_result(LocalTopK(np.empty((0, 1)), k, metric).drain(), asked["qid"].combine_chunks())]
        for q, names in _by_length(asked):
            top = LocalTopK(q, k, metric)
            found += [_result(x, names) for x in (*_feed(top, table, q.shape[1]), top.drain())]
        return pa.Table.from_batches(found)

    cell = ["namespace", "block", "part"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(score, _schema(qid_type))


def _by_length(table: pa.Table) -> list[tuple[np.ndarray, pa.Array]]:
    """Queries as one matrix for each length, with their names."""
    qids, column = table["qid"].combine_chunks(), table["qv"].combine_chunks()
    out = []
    for length in column.value_lengths().unique().to_pylist() if len(column) else []:
        matrix, rows = as_matrix(column, length)
        if len(rows):
            out.append((matrix, qids.take(pa.array(rows))))
    return out


def _check(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")


def _qid_type(queries: DataFrame) -> str:
    return queries.schema["qid"].dataType.simpleString()


def _schema(qid_type: str) -> str:
    return f"qid {qid_type}, namespace string, id string, score double"


def _result(found: dict[str, np.ndarray], qids: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [qids.take(pa.array(found["query"])), pa.array(found["namespace"], pa.string()),
         pa.array(found["id"], pa.string()), pa.array(found["score"])],
        names=["qid", "namespace", "id", "score"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together up to the size of a scoring block."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ROW_BLOCK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _feed(top: LocalTopK, table: pa.Table, dimension: int):
    matrix, rows = as_matrix(table.column("values"), dimension)
    ids, names = (table.column(c).take(pa.array(rows)) for c in ("id", "namespace"))
    coded = names.combine_chunks().dictionary_encode()
    return top.add(matrix, np.array(ids.to_pylist(), dtype=object), coded.dictionary.to_pylist(),
                   coded.indices.to_numpy(zero_copy_only=False))


def _candidates(vectors: DataFrame) -> DataFrame:
    """The three columns a search reads; float elements stay floats until they are in numpy."""
    return vectors.select("namespace", "id", "values").filter(
        F.col("id").isNotNull() & F.col("namespace").isNotNull() & F.col("values").isNotNull())


def _local(vectors: DataFrame, parts: list[tuple[np.ndarray, pa.Array]], qid_type: str, k: int,
           metric: str) -> DataFrame:
    _check(metric)
    shared = vectors.sparkSession.sparkContext.broadcast(parts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [(LocalTopK(q, k, metric), q.shape[1], names) for q, names in shared.value]
        for table in _gathered(batches):
            for top, dimension, names in tops:
                for full in _feed(top, table, dimension):
                    yield _result(full, names)
        for top, _, names in tops:
            yield _result(top.drain(), names)

    return _candidates(vectors).mapInArrow(score, _schema(qid_type))


def _ranked(winners: DataFrame, k: int, cores: int) -> DataFrame:
    """Final ranking. On a large cluster winners are first merged in groups, so that the last task of a hot
    namespace does not get k rows from every input split."""
    best = [F.desc("score"), F.asc("id")]
    if cores > MERGE_FAN_IN:
        groups = math.ceil(math.sqrt(cores))
        w = Window.partitionBy("qid", "namespace", "part").orderBy(*best)
        winners = winners.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups))) \
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("part", "rank")
    w = Window.partitionBy("qid", "namespace").orderBy(*best)
    return winners.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("qid", "namespace", "id", "score", F.col("rank").cast("long").alias("rank"))
