"""Sources mixed to target weights, by pivotal dependent rounding of fractional copies."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from loamline.session import cut_lineage

TOKENIZERS = "/opt/tokenizers"  # where the public vocabulary files lie; a parameter, never part of the repository
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that the vocabulary's words are cut by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PER_GROUP = 4_096  # documents, then residuals, that one task rounds at a time
FAN_IN = 512  # groups whose residuals meet in a node of the reduction tree
WHOLE = 1e-9
MAX_TARGETS = 100_000  # rows of the table of targets, which the driver reads


@lru_cache(maxsize=2)
def _encoding(path: str):  # noqa: ANN202
    import tiktoken

    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        token, rank = line.split()
        ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding(Path(path).name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokens_of(text: Column, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text in a public vocabulary; 0 for null. Whole texts, encoded in the workers."""
    path = f"{tokenizers.rstrip('/')}/{vocabulary}"

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoding(path).encode_ordinary
        return pd.Series([len(encode(x)) if x is not None else 0 for x in texts], dtype="int64")

    return count(text)


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) from keys and a salt: a retried task draws the same."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def pivot(part: np.ndarray, weight: np.ndarray, keys: np.ndarray, salt: int) -> np.ndarray:
    """Rounds fractions in [0, 1] to 0 or 1, all but at most one, keeping the weighted sum and every expectation.

    Two fractions at a time: weight moves from one to the other, in a random direction, until one of them is whole; the
    direction's odds are such that neither's expectation changes.
    """
    out = part.astype(np.float64).copy()
    chance = _uniform(keys, salt)
    held = -1
    for i in range(len(out)):
        if out[i] <= WHOLE or out[i] >= 1 - WHOLE:
            out[i] = round(out[i])
            continue
        if held < 0:
            held = i
            continue
        a, b, wa, wb = out[held], out[i], weight[held], weight[i]
        up = min((1 - a) * wa, b * wb)  # weight that may go to the held one
        down = min(a * wa, (1 - b) * wb)
        if chance[i] * (up + down) < down:
            a, b = a + up / wa, b - up / wb
        else:
            a, b = a - down / wa, b + down / wb
        out[held], out[i] = a, b
        whole_a, whole_b = a <= WHOLE or a >= 1 - WHOLE, b <= WHOLE or b >= 1 - WHOLE
        if whole_a:
            out[held] = round(a)
        if whole_b:
            out[i] = round(b)
        held = held if not whole_a else (i if not whole_b else -1)
    return out


def _rounded(salt: int, last: bool):  # noqa: ANN202
    def run(rows: pa.Table) -> pa.Table:
        key = rows.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        part, weight = rows.column("part").to_numpy()[order], rows.column("weight").to_numpy()[order].astype(np.float64)
        out = pivot(part, np.maximum(weight, 1e-12), key[order], salt)
        if last:  # the one residual of a source: a toss at its own odds
            rest = (out > WHOLE) & (out < 1 - WHOLE)
            out[rest] = (_uniform(key[order], salt + 1)[rest] < out[rest]).astype(float)
        names = ["source", "node", "key", "weight", "whole"]
        return pa.table([*(rows.column(c).take(pa.array(order)) for c in names), pa.array(out)], names=[*names, "part"])

    return run


_ROWS = "source string, node long, key long, weight long, whole int, part double"


def mix_sources(
    documents: DataFrame, doc_id: str, source: str, tokens: Column, targets: DataFrame, *, total: float | None = None, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """``(copies, report)``: how often each document is used so that every source reaches its target share of all tokens.

    targets: ``(source, target_share, max_repeats)``. copies: ``(doc_id, source, tokens, copies)`` for every document that is
    used; no document more than ``max_repeats`` times. report: one row per source with the share wanted and reached.

    total: tokens wanted; None takes the largest at which no source that is present would exceed its repeats, so that all
    present sources keep their shares. With a larger total a source that runs out is used ``max_repeats`` times and stays
    below its share. Shares of absent sources go to the present ones in proportion. Documents of sources without a target,
    with null ids or sources, or without a token are left out; null or non-positive shares and repeats count as none.
    Repeated rows of an id count once. Empty tables give no copies, and a report of zeros.

    Plan: one narrow pass counts tokens; sums per source are pre-aggregated. Fractions are rounded by pivoting in groups of
    about PER_GROUP documents of a source, a hot source being many groups, and the one residual of each group moves up a
    reduction tree of fan-in FAN_IN until one is left per source: a source misses its tokens by less than one document.
    """
    goal = targets.where((F.col("target_share") > 0) & (F.col("max_repeats") > 0) & F.col("source").isNotNull()).groupBy("source").agg(
        F.max("target_share").alias("target_share"), F.max("max_repeats").cast("int").alias("max_repeats")
    )
    counted = documents.select(F.col(doc_id).cast("long").alias("key"), F.col(source).cast("string").alias("source"), tokens.cast("long").alias("weight"))
    counted = counted.where(F.col("key").isNotNull() & F.col("source").isNotNull()).groupBy("key", "source").agg(F.max("weight").alias("weight"))
    counted = cut_lineage(counted.where(F.col("weight") > 0).join(F.broadcast(goal.select("source")), "source", "left_semi"))
    sums = counted.groupBy("source").agg(F.sum("weight").alias("have"), F.count(F.lit(1)).alias("documents"))
    plan = goal.join(sums, "source", "left").limit(MAX_TARGETS + 1).toPandas()
    if len(plan) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    have = plan["have"].fillna(0).to_numpy(dtype=float)
    share = np.where(have > 0, plan["target_share"].to_numpy(dtype=float), 0.0)
    share = share / share.sum() if share.sum() > 0 else share
    limit = have * plan["max_repeats"].to_numpy(dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        largest = np.min(np.where(share > 0, limit / share, np.inf)) if (share > 0).any() else 0.0
        wanted = np.minimum(share * (largest if total is None else total), limit)
        rate = np.where(have > 0, wanted / have, 0.0)
    spark = documents.sparkSession
    rows = [(s, float(r), int(n)) for s, r, n in zip(plan["source"], rate, plan["documents"].fillna(0)) if r > 0]
    rates = F.broadcast(spark.createDataFrame(rows, "source string, rate double, n long"))
    node = F.pmod(F.xxhash64("key"), F.greatest(F.ceil(F.col("n") / PER_GROUP), F.lit(1)))
    start = counted.join(rates, "source").select(
        "source", node.alias("node"), "key", "weight", F.floor(F.col("rate") + WHOLE).cast("int").alias("whole"),
        F.greatest(F.col("rate") - F.floor(F.col("rate") + WHOLE), F.lit(0.0)).alias("part"),
    )
    nodes = max([-(-n // PER_GROUP) for _, _, n in rows] or [1])
    done, level = [], 0
    while True:
        last = nodes <= 1
        now = start.groupBy("source", "node").applyInArrow(_rounded(seed + 2 * level, last), _ROWS)
        if last:
            done.append(now)
            break
        now = cut_lineage(now)
        fraction = (F.col("part") > WHOLE) & (F.col("part") < 1 - WHOLE)
        done.append(now.where(~fraction))
        start = now.where(fraction).withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
        nodes, level = -(-nodes // FAN_IN), level + 1
    whole = done[0]
    for x in done[1:]:
        whole = whole.unionByName(x)
    used = whole.select(
        F.col("key").alias(doc_id), "source", F.col("weight").alias("tokens"), (F.col("whole") + F.round("part").cast("int")).alias("copies")
    ).where(F.col("copies") > 0)
    reached = used.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("tokens_used"), F.count(F.lit(1)).alias("documents_used"), F.max("copies").alias("most_copies")
    )
    report = goal.join(sums.withColumnRenamed("have", "tokens_available"), "source", "left").join(reached, "source", "left").na.fill(
        0, ["tokens_available", "documents", "tokens_used", "documents_used", "most_copies"]
    )
    all_used = F.sum("tokens_used").over(Window.partitionBy(F.lit(1)))  # one row per target
    share_reached = F.coalesce(F.col("tokens_used") / F.nullif(all_used, F.lit(0)), F.lit(0.0))
    return used, report.withColumn("share_reached", share_reached)
