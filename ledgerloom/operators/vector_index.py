"""An inverted-file index over vectors: every vector in the list of its nearest centre, a few lists probed per query.

Centres are fitted (``pyspark.ml`` k-means on unit vectors) to a bounded sample: at most
``SAMPLE_PER_LIST`` different vectors per list, chosen by a hash of the vector. Every row is then put
into a list, and a list is written as blocks of about ``BLOCK_ROWS`` vectors, partitioned by list, so
a probe reads its lists only. Queries are dealt into blocks per probed list; a block of queries meets a
block of vectors as one row and leaves its best ``k``. A list of any size, such as that of a vector
which a third of the rows repeat, is spread over its blocks. Only the centres and the counts per list
(at most ``MOST_LISTS`` of each) are sent to all tasks.

With all lists probed the answer is exact. Vectors that are null, empty or zero, or hold a null or
non-finite entry, have no direction: they are kept in list -1 and are never found, and such queries
find nothing. Vectors of another length than most are treated the same. Repeated rows and ids stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import settled
from .rows import top_per_group

MOST_LISTS, SAMPLE_PER_LIST, BLOCK_ROWS, QUERY_ROWS = 4096, 256, 1024, 256
DIGITS = 9
"""Similarities are compared and returned with so many decimals, so that equal vectors tie."""
NO_LIST = -1


@dataclass(frozen=True)
class VectorIndex:
    """Where the blocks are, their columns, and the unit vectors of the centres."""

    spark: SparkSession
    path: str
    schema: StructType
    centres: np.ndarray

    @property
    def blocks(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def _directions(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors by row; NaN for those without a direction or of another length."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    out = np.full((len(lengths), size), np.nan)
    right = np.flatnonzero(lengths == size)
    out[right] = entries[starts[right][:, None] + np.arange(size)]
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        out /= np.sqrt((out * out).sum(axis=1, keepdims=True))
    out[~np.isfinite(out).all(axis=1)] = np.nan
    return out


def _nearest(centres: np.ndarray, probes: int):
    """Batches with ``id``, ``vector`` in; a row per vector and one of its nearest lists out (list -1 without a direction)."""

    def emit(batches):
        for batch in batches:
            units = _directions(batch.column("vector"), centres.shape[1])
            lost = np.isnan(units[:, 0])
            near = np.nan_to_num(units) @ centres.T
            lists = np.argsort(-near, axis=1, kind="stable")[:, :probes] if probes > 1 else near.argmax(axis=1)[:, None]
            row = np.concatenate((np.repeat(np.flatnonzero(~lost), lists.shape[1]), np.flatnonzero(lost)))
            chosen = np.concatenate((lists[~lost].reshape(-1), np.full(lost.sum(), NO_LIST)))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("vector").take(at), pa.array(chosen, pa.int32())], ["id", "vector", "list"])

    return emit


def fit_centres(vectors: DataFrame, vector: str, lists: int, seed: int = 1) -> np.ndarray:
    """Unit vectors of at most ``lists`` centres; none if no vector has a direction."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    entries = F.col("vector")
    sound = vectors.select(F.transform(vector, lambda x: x.cast("double")).alias("vector")).where(
        (F.size(entries) > 0) & F.forall(entries, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists(entries, lambda x: x != 0)
    )
    sizes = sound.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None:
        return np.zeros((0, 1))
    size, count = sizes
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    units = sound.where(F.size("vector") == size).select(length.alias("length"), "vector").where((F.col("length") > 0) & (F.col("length") < F.lit(float("inf"))))
    units, most = units.select(F.transform("vector", lambda x: x / F.col("length")).alias("unit")), lists * SAMPLE_PER_LIST
    place = F.pmod(F.xxhash64("unit"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = settled((units if count <= most else units.where(place < most / count)).distinct().limit(most))
    if sample.isEmpty():  # few vectors, repeated throughout
        sample = units.limit(1)
    if sample.count() <= max(2, lists):
        return np.array([r["unit"] for r in sample.limit(lists).collect()]).reshape(-1, size)
    model = KMeans(k=max(2, lists), maxIter=10, seed=seed, initMode="random").fit(sample.select(array_to_vector("unit").alias("features")))
    centres = np.array([np.asarray(c) for c in model.clusterCenters()])[:lists]
    length = np.sqrt((centres * centres).sum(axis=1, keepdims=True))
    return centres / np.where(length > 0, length, 1)


def _in_blocks(assigned: DataFrame, rows: int) -> DataFrame:
    """``list``, ``block``, ``items`` (id, vector): the rows of files already written, dealt out by chance into blocks of about so many."""
    counts = settled(assigned.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / rows).alias("blocks")))
    dealt = assigned.join(F.broadcast(counts), "list")  # a row per list
    place = F.floor(F.rand(7) * F.col("blocks"))
    return dealt.withColumn("block", place).groupBy("list", "block").agg(F.collect_list(F.struct("id", "vector")).alias("items"))


def build_index(vectors: DataFrame, path: str, vec_id: str = "vec_id", vector: str = "embedding", lists: int | None = None) -> VectorIndex:
    """Write the index of all rows to ``path``; by default the root of their number of lists, ``MOST_LISTS`` at most."""
    given = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"))
    lists = min(MOST_LISTS, lists or max(1, math.isqrt(given.count())))
    centres = fit_centres(given, "vector", lists)
    if len(centres):
        assigned = settled(given.mapInArrow(_nearest(centres, 1), given.withColumn("list", F.lit(0)).schema))
    else:
        assigned = settled(given.withColumn("list", F.lit(NO_LIST)))
    blocks = _in_blocks(assigned, BLOCK_ROWS).repartition("list", "block").select("items", "list")
    blocks.write.partitionBy("list").parquet(path)
    return VectorIndex(vectors.sparkSession, path, blocks.schema, centres)


def _matrix(items) -> np.ndarray:
    return np.array([x["vector"] for x in items], np.float64)


def search(index: VectorIndex, queries: DataFrame, k: int, probes: int, query_id: str = "query_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``vec_id``, ``similarity``, ``rank`` of the ``k`` nearest vectors in the ``probes`` nearest lists of each query.

    Ties are ranked by ``vec_id``. Query ids must be unique.
    """
    given = queries.select(F.col(query_id).alias("id"), F.col(vector).alias("vector"))
    blocks = index.blocks
    id_type = blocks.schema["items"].dataType.elementType["id"].dataType.simpleString()
    schema = f"query_id {given.schema['id'].dataType.simpleString()}, vec_id {id_type}, similarity double"
    if not len(index.centres):
        return index.spark.createDataFrame([], schema + ", rank int")
    asked = settled(given.mapInArrow(_nearest(index.centres, max(1, probes)), given.withColumn("list", F.lit(0)).schema).where(F.col("list") != NO_LIST))
    asked = _in_blocks(asked, QUERY_ROWS).select("list", F.col("items").alias("asked"))
    met = blocks.where(F.col("list") != NO_LIST).join(asked, "list").select("items", "asked")

    def score(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                items, mine = batch.column("items")[at].as_py(), batch.column("asked")[at].as_py()
                left, right = _matrix(mine), _matrix(items)
                norms = np.sqrt((left * left).sum(axis=1))[:, None] * np.sqrt((right * right).sum(axis=1))[None, :]
                near = np.round(left @ right.T / norms, DIGITS)
                ids = pa.array([x["id"] for x in items], batch.schema.field("items").type.value_type.field("id").type)
                by_id = pc.array_sort_indices(ids).to_numpy()
                best = by_id[np.argsort(-near[:, by_id], axis=1, kind="stable")[:, :k]]
                rows = np.repeat(np.arange(len(mine)), best.shape[1])
                names = pa.array([x["id"] for x in mine], batch.schema.field("asked").type.value_type.field("id").type)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(rows)), ids.take(pa.array(best.reshape(-1))), pa.array(near[rows, best.reshape(-1)])], ["query_id", "vec_id", "similarity"])

    found = met.mapInArrow(score, schema)
    order = [F.col("similarity").desc(), F.col("vec_id")]
    best = top_per_group(found, ["query_id"], order, k)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("far"), "vec_id", "similarity")))
    return best.groupBy("query_id").agg(ranked.alias("best")).select("query_id", F.posexplode("best").alias("place", "one")).select(
        "query_id", "one.vec_id", "one.similarity", (F.col("place") + 1).alias("rank")
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``queries`` and the ``recall`` of ``found`` among the pairs of ``exact``."""
    hits = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hits.agg(F.countDistinct("query_id").alias("queries"), (F.coalesce(F.sum("hit"), F.lit(0)) / F.count(F.lit(1))).alias("recall"))
