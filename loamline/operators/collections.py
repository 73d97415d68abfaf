"""Collections of points: layouts, search modes, overfetch with a filter afterwards, and their storage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.functions.payloads import PAYLOAD_FIELDS
from loamline.operators.retrieval import dense_topk, merge_scored, rrf
from loamline.sources.sinks import upsert

# Named vectors of each layout, and which of them a search mode asks, by its variant; the first is the default.
LAYOUTS = {
    "legacy": ["vector"], "dual": ["sentence", "semantic"], "dense_named": ["dense"], "sentence_named": ["sentence"], "research_dual": ["abstract_vector", "content_vector"],
    "ota_triple": ["insight_vector", "metric_vector", "recommendation_vector"], "bq_triple": ["table_vector", "schema_vector", "business_vector"],
}
MODES = {
    "legacy": {"": ["vector"]}, "dense_named": {"": ["dense"]}, "sentence_named": {"": ["sentence"]},
    "dual": {"both": ["sentence", "semantic"], "sentence": ["sentence"], "semantic": ["semantic"]},
    "research_dual": {"content": ["content_vector"], "abstract": ["abstract_vector"], "merge": ["abstract_vector", "content_vector"]},
    "ota_triple": {"merge": LAYOUTS["ota_triple"], "insight": ["insight_vector"], "metric": ["metric_vector"], "recommendation": ["recommendation_vector"]},
    "bq_triple": {"merge": LAYOUTS["bq_triple"], "table": ["table_vector"], "schema": ["schema_vector"], "business": ["business_vector"]},
}
CORPUS_LAYOUT = {"news": "dense_named", "research": "dense_named", "ota": "ota_triple", "data_description": "bq_triple"}
OVERFETCH, MOST_OVERFETCH = 8, 50  # how many times the wanted hits are fetched where a filter follows; the most that may be asked


def vectors_of(mode: str, using: str = "") -> list[str]:
    """Named vectors that a mode asks; an unknown variant is the default one, an unknown mode an error."""
    if mode not in MODES:
        raise ValueError(f"unknown search mode {mode!r}: one of {', '.join(MODES)}")
    variants = MODES[mode]
    return variants.get(using, next(iter(variants.values())))


def search(points: DataFrame, item: str, queries: DataFrame, query: str, query_vector: str, k: int, *, mode: str = "legacy", using: str = "") -> DataFrame:
    """``(query, item, score, rank)``: the k nearest points by the best of the vectors that the mode asks, each fetched k deep."""
    names = vectors_of(mode, using)
    lists = [dense_topk(points, item, n, queries, query, query_vector, k) for n in names]
    if len(lists) == 1:
        return lists[0]
    return merge_scored(reduce(DataFrame.unionByName, lists).drop("rank"), query, item, k)


def filtered_after(
    hits: Callable[[int], DataFrame], payloads: DataFrame, item: str, query: str, condition: Column | None, k: int, *, hybrid: bool = False, overfetch: int | None = None
) -> DataFrame:
    """The k best hits that meet a condition on their payload, which is asked after the search: ``hits(n)`` gives the n best.

    Fetched are OVERFETCH times as many where there is a condition, unless the search is hybrid; at most MOST_OVERFETCH.
    Fewer than k come out where fewer of those fetched pass.
    """
    times = 1 if hybrid or condition is None else OVERFETCH
    times = max(1, min(overfetch if overfetch is not None and not hybrid else times, MOST_OVERFETCH))
    fetched = hits(k * times)
    kept = fetched if condition is None else fetched.join(payloads.where(condition).select(item).distinct(), item, "left_semi")
    w = Window.partitionBy(query).orderBy(F.desc("score"), item)
    return kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hybrid_or_dense(dense: DataFrame, sparse: Callable[[], DataFrame] | None, query: str, item: str, k: int) -> DataFrame:
    """Fusion of both branches; the dense branch alone where there is no sparse one or it cannot be built."""
    try:
        other = sparse() if sparse else None
    except Exception:  # noqa: BLE001
        other = None
    if other is None:
        w = Window.partitionBy(query).orderBy(F.desc("score"), item)
        return dense.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(query, item, "score", "rank")
    return rrf([dense, other], query, item, k)


class Collection:
    """Points of a corpus in a folder that all executors share: ``id``, its named vectors, ``payload`` and ``version``."""

    def __init__(self, spark: SparkSession, root: str, name: str, corpus: str):
        self.spark, self.path, self.corpus = spark, f"{root.rstrip('/')}/{name}", corpus
        self.vectors, self.fields = LAYOUTS[CORPUS_LAYOUT[corpus]], PAYLOAD_FIELDS[corpus]

    def _generations(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("gen=")) if fs.exists(path) else []

    def _drop(self, names: list[str]) -> None:
        for n in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @property
    def schema(self) -> str:
        return ", ".join(["id string", *[f"{v} array<float>" for v in self.vectors], "payload map<string,string>", "version string"])

    def create(self, *, reset: bool = False) -> None:
        """An empty collection where there is none, or anew."""
        known = self._generations()
        if reset or not known:
            self._write(self.spark.createDataFrame([], self.schema), known)

    def _write(self, points: DataFrame, old: list[str]) -> None:
        at = 1 + max((int(g[4:]) for g in old), default=0)
        points.write.mode("overwrite").parquet(f"{self.path}/gen={at:09d}")
        self._drop(old)  # readers of the old generation are done with it only now

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self._generations()[-1]}")

    def upsert(self, points: DataFrame) -> None:
        """Points by id, the latest version of each; the same batch twice changes nothing. Vectors of other layouts are refused."""
        missing = [v for v in self.vectors if v not in points.columns]
        if missing:
            raise ValueError(f"{self.corpus}: no vector {', '.join(missing)}")
        allowed = F.array(*[F.lit(f) for f in self.fields])
        new = points.select("id", *self.vectors, F.map_filter("payload", lambda k, v: F.array_contains(allowed, k) & v.isNotNull()).alias("payload"), F.col("version").cast("string"))
        old = self._generations()
        every = upsert(self.read().withColumn("_p", F.to_json("payload")) if old else None, new.withColumn("_p", F.to_json("payload")), "id", "version", ignore=["payload"])
        self._write(every.drop("_p"), old)
