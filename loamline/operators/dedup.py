"""Incremental and sequential deduplication by keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.session import cut_lineage


def manifest_new(rows: DataFrame, manifest: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key that the manifest does not hold, by ``order``; null keys are new each on their own."""
    fresh = rows.join(manifest.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    known, null = fresh.where(F.col(key).isNotNull()), fresh.where(F.col(key).isNull())
    others = [c for c in rows.columns if c not in (key, order)]
    first = known.groupBy(key).agg(F.min_by(F.struct(order, *others), order).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in (order, *others)])
    return first.select(rows.columns).unionByName(null.select(rows.columns))


def sequential_duplicates(rows: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """``rows`` with ``is_duplicate``: whether an earlier row that is no duplicate itself shares any of the keys.

    Rows are taken by ``order``, which is unique; duplicates do not register their other keys, so this is no single window. In
    each round the rows that come first in all of their keys among those not ruled out are originals, and rows that share a
    key with an earlier original are duplicates; rounds end when all are decided. Minima per key are pre-aggregated, no group
    is gathered. Null and empty keys never match. A row without any key is an original.
    """
    open_rows = cut_lineage(rows.select(order, *keys))
    originals = duplicates = None
    plus = lambda a, b: b if a is None else a.unionByName(b)
    while not open_rows.isEmpty():
        first = open_rows
        for k in keys:
            least = open_rows.where(F.col(k) != "").groupBy(k).agg(F.min(order).alias(f"_first_{k}"))
            first = first.join(least, k, "left")
        ok = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"_first_{k}") == F.col(order), F.lit(True)) for k in keys])
        found = cut_lineage(first.where(ok).select(order, *keys))
        rest = open_rows.join(found.select(order), order, "left_anti")
        hit = rest
        for k in keys:
            hit = hit.join(found.where(F.col(k) != "").groupBy(k).agg(F.min(order).alias(f"_orig_{k}")), k, "left")
        late = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"_orig_{k}") < F.col(order), F.lit(False)) for k in keys])
        judged = cut_lineage(hit.select(order, *keys, late.alias("_late")))
        originals, duplicates = plus(originals, found.select(order)), plus(duplicates, judged.where("_late").select(order))
        open_rows = judged.where(~F.col("_late")).select(order, *keys)
    if originals is None:
        return rows.withColumn("is_duplicate", F.lit(False))
    return rows.join(duplicates.withColumn("is_duplicate", F.lit(True)), order, "left").withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(False)))
