"""Vector retrieval inside collections, and checks of a vector store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .rows import top_per_group


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def topk_cosine(vectors: DataFrame, queries: DataFrame, collection: str, k: int) -> DataFrame:
    """The ``k`` nearest vectors of each query within the query's collection.

    ``vectors(vec_id, embedding, <collection>)``, ``queries(query_id, query, <collection>)``.
    An equi-join on the collection; each task keeps ``k`` rows per query before the shuffle.
    """
    scored = vectors.join(queries, collection).select(
        "query_id", "vec_id", cosine(F.col("embedding"), F.col("query")).alias("similarity")
    )
    return top_per_group(scored, ["query_id"], [F.col("similarity").desc(), F.col("vec_id")], k)


def centroids(vectors: DataFrame, collection: str) -> DataFrame:
    """The mean vector of each collection, summed element by element."""
    elements = vectors.select(collection, F.posexplode("embedding").alias("_at", "_x"))
    means = elements.groupBy(collection, "_at").agg(F.avg(F.col("_x").cast("double")).alias("_mean"))
    ordered = F.array_sort(F.collect_list(F.struct("_at", "_mean")))
    return means.groupBy(collection).agg(F.transform(ordered, lambda item: item["_mean"]).alias("query"))


def store_consistency(documents: DataFrame, store: DataFrame, key: str, content_hash: str) -> DataFrame:
    """Every id of either side: ``current``, ``stale``, ``missing`` (no vector) or ``orphan``."""
    left = documents.select(key, F.col(content_hash).alias("_doc"), F.lit(True).alias("_in_docs"))
    right = store.select(key, F.col(content_hash).alias("_vec"), F.lit(True).alias("_in_store"))
    status = (
        F.when(F.col("_in_store").isNull(), "missing")
        .when(F.col("_in_docs").isNull(), "orphan")
        .when(F.col("_doc").eqNullSafe(F.col("_vec")), "current")
        .otherwise("stale")
    )
    return left.join(right, key, "full_outer").select(key, status.alias("status"))
