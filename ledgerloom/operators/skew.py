"""Joins of a large table with its dimensions where some keys hold much of the rows.

One pass over the key columns sketches the frequent keys of all joins (``approx_top_k``). A key with more than
``SHARE`` of the rows is cut into as many slices as it has shares: its rows are dealt over the slices by their
own hash, its dimension rows are repeated once per slice, and the slice joins the key. No task then
holds much more than ``SHARE`` of the rows, whatever the key. At most ``1 / SHARE`` keys can be heavy, with
twice as many slices in all, so what is repeated is bounded too. All other rows join as ever, and without
a heavy key the join is a plain one. Rows equal in every column share a slice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SHARE, TRACKED = 0.01, 10_000
_SLICE = "_slice"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def heavy_keys(rows: DataFrame, key_sets: Sequence[Sequence[str]], share: float = SHARE) -> list[dict[int, int]]:
    """For each set of key columns the hashes of its heavy keys, and the slices each is cut into."""
    most = math.ceil(1 / share)
    top = [F.call_function("approx_top_k", _hash(keys), F.lit(most), F.lit(TRACKED)).alias(f"top{i}") for i, keys in enumerate(key_sets)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *top).first()
    heavy = lambda items: {x["item"]: math.ceil(x["count"] / (share * found.n)) for x in items or () if x["count"] > share * found.n}
    return [heavy(found[f"top{i}"]) for i in range(len(key_sets))]


def _slices(keys: Sequence[str], heavy: dict[int, int]) -> Column:
    known = F.create_map(*[F.lit(x).cast(kind) for pair in heavy.items() for x, kind in zip(pair, ("bigint", "int"))])
    return F.coalesce(F.element_at(known, _hash(keys)), F.lit(1))


def sliced_join(rows: DataFrame, dimension: DataFrame, keys: Sequence[str], heavy: dict[int, int], how: str = "inner", dealt_by: Column | None = None) -> DataFrame:
    """``rows`` joined with ``dimension`` on ``keys`` (``inner`` or ``left``), the heavy keys in slices; ``dealt_by`` deals their rows."""
    keys = list(keys)
    if not heavy:
        return rows.join(dimension, keys, how)
    own = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.lit(_SLICE)) if dealt_by is None else dealt_by
    dealt = rows.withColumn(_SLICE, F.pmod(own, _slices(keys, heavy)).cast("int"))
    repeated = dimension.withColumn(_SLICE, F.explode(F.sequence(F.lit(0), _slices(keys, heavy) - 1)))
    return dealt.join(repeated, [*keys, _SLICE], how).drop(_SLICE)


def heavy_key_joins(rows: DataFrame, dimensions: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "inner", share: float = SHARE) -> DataFrame:
    """``rows`` joined with each dimension on its keys, after one pass that finds the heavy keys of all of them."""
    found = heavy_keys(rows, [keys for _, keys in dimensions], share)
    deal = "_dealt"
    joined = rows.withColumn(deal, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.lit(_SLICE)))
    for (dimension, keys), heavy in zip(dimensions, found):
        joined = sliced_join(joined, dimension, keys, heavy, how, F.col(deal))
    return joined.drop(deal)
