"""Near-duplicate records: consistent weighted sampling over TF-IDF shingles, banded, then verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.operators.components import connected
from loamline.session import cut_lineage

IDF_POWER = 2.0  # as in the cosine of TF-IDF vectors, a shingle that two records share counts with the idf of both
ROWS, BANDS = 2, 24  # a pair of weighted similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS
# The same with all weights one: where a large part of all records shares its wording, those shingles weigh next to nothing by
# idf, and records that differ in a rare one only would look unlike.
EVEN_ROWS, EVEN_BANDS = 4, 20
LARGE_BUCKET = 40  # beyond it a bucket is compared with one member first, and only those unlike it with others


def words_of(text: Column | str) -> Column:
    """Distinct runs of letters or digits in lower case, sorted; an empty array for null."""
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    return F.array_sort(F.array_distinct(F.coalesce(F.regexp_extract_all(t, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), F.array().cast("array<string>"))))


def shingles_of(text: Column | str, size: int) -> Column:
    """Distinct runs of ``size`` successive words, sorted; a text of fewer words is one shingle, null or no word gives none."""
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    all_words = F.regexp_extract_all(t, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    n = F.size(all_words)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.array_join(F.slice(all_words, i, size), " "))
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.array_sort(F.array_distinct(runs))).otherwise(F.array().cast("array<string>"))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: unrelated bits for each integer."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _samples(keys: np.ndarray, weights: np.ndarray, draws: int) -> tuple[np.ndarray, np.ndarray]:
    """Improved consistent weighted sampling of single shingles: for each shingle and draw its race time and its sample.

    r and c are Gamma(2, 1), b uniform, all from the shingle's hash; t = floor(ln w / r + b), ln y = r (t - b),
    ln a = ln c - ln y - r. A set's sample in a draw is (shingle, t) of its least a.
    """
    draw = _mix(np.arange(1, draws + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    base = _mix(keys[:, None] ^ draw[None, :])
    with np.errstate(over="ignore"):
        uniform = lambda i: ((_mix(base + np.uint64(i) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(11)) + 0.5) * 2.0**-53
        r = -np.log(uniform(1) * uniform(2))
        c = -np.log(uniform(3) * uniform(4))
        b = uniform(5)
        t = np.floor(np.log(weights)[:, None] / r + b)
        time = np.log(c) - r * (t - b) - r
        sample = _mix(base ^ t.astype(np.int64).astype(np.uint64))
    return time.astype(np.float32), sample


def _even_samples(keys: np.ndarray, draws: int) -> np.ndarray:
    """With equal weights a set's sample is the shingle of its least hash, and that hash names it."""
    draw = _mix((np.arange(1, draws + 1, dtype=np.uint64) + np.uint64(1 << 20)) * np.uint64(0x9E3779B97F4A7C15))
    return _mix(keys[:, None] ^ draw[None, :])


def _joined(chosen: np.ndarray, salt: int) -> np.ndarray:
    """One key for each band of samples."""
    key = _mix(np.arange(len(chosen), dtype=np.uint64) + np.uint64(salt))
    for j in range(chosen.shape[1]):
        key = _mix(key ^ chosen[:, j])
    return key


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set_id, key) for each band of each set; shingle hashes and weights come as arrays."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            hashes, weights = part.column(1), part.column(2)
            starts = np.asarray(hashes.offsets)
            lengths = np.diff(starts)
            values = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            unique, first, where = np.unique(values, return_index=True, return_inverse=True)
            time, sample = _samples(unique, weights.flatten().to_numpy(zero_copy_only=False)[first], ROWS * BANDS)
            ids = part.column(0).to_numpy()
            even = _even_samples(unique, EVEN_ROWS * EVEN_BANDS)
            out = np.empty((part.num_rows, BANDS + EVEN_BANDS), dtype=np.uint64)
            begin = np.r_[0, np.cumsum(lengths)]
            draws = np.arange(ROWS * BANDS)
            for i in range(part.num_rows):
                mine = where[begin[i] : begin[i + 1]]
                out[i, :BANDS] = _joined(sample[mine[time[mine].argmin(axis=0)], draws].reshape(BANDS, ROWS), 77)
                out[i, BANDS:] = _joined(even[mine].min(axis=0).reshape(EVEN_BANDS, EVEN_ROWS), 7777)
            yield pa.record_batch([pa.array(np.repeat(ids, BANDS + EVEN_BANDS)), pa.array(out.reshape(-1).view(np.int64))], names=["set_id", "key"])


def linked_sets(sets: DataFrame, threshold: float, *, weighted: bool = False, frequencies: bool = False) -> DataFrame:
    """``(a, b, similarity)``, a < b: links between the distinct sets ``(set_id, shingles)`` that are at least ``threshold`` alike.

    Candidates share a band of consistent weighted samples (weights: tf x idf to the power IDF_POWER, counted over all sets;
    and, in further bands, all weights one) and are then verified by weighted Jaccard similarity: with those weights, or, unless
    ``weighted``, with all weights one. tf is 1 unless ``frequencies``: then shingles may repeat and count as often.

    All candidates of buckets of up to LARGE_BUCKET sets are links of their own. A larger bucket never gives all its pairs:
    its members are verified against its first one, and are linked through it where they are alike. The members that are not
    alike meet the whole bucket by prefix filtering: two sets that are ``threshold`` alike share one of the rarest shingles of
    each, so that only these are joined, and no link between a member and the rest is lost. The links' connected components are
    the groups of all pairs that share a band; the pairs within a component are not all listed.
    """
    n = sets.count()
    terms = sets.select("set_id", F.explode(F.transform("shingles", lambda s: F.xxhash64(s))).alias("h"))
    terms = terms.groupBy("set_id", "h").agg(F.count(F.lit(1)).alias("tf")) if frequencies else terms.withColumn("tf", F.lit(1))
    idf = F.pow(F.log1p(F.lit(float(max(n, 1))) / F.count(F.lit(1))), F.lit(IDF_POWER))
    weighed = terms.join(terms.groupBy("h").agg(idf.alias("idf")), "h").select("set_id", "h", (F.col("tf") * F.col("idf")).alias("w"), F.col("idf"))
    hashed = cut_lineage(  # the rarest shingles first
        weighed.groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("idf")).alias("o"), "h", "w"))).alias("x")).select("set_id", F.col("x.h").alias("h"), F.col("x.w").alias("w"))
    )
    bands = hashed.mapInArrow(_band_keys, "set_id long, key long").repartition("key")
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("set_id").alias("first")).where(F.col("size") > 1)
    members = cut_lineage(bands.join(buckets, "key"))  # most keys are a set's alone and end here
    small = members.where(F.col("size") <= LARGE_BUCKET).select("key", "set_id")
    pairs = small.select("key", F.col("set_id").alias("a")).join(small.select("key", F.col("set_id").alias("b")), "key").where("a < b").select("a", "b")
    large = members.where((F.col("size") > LARGE_BUCKET) & (F.col("set_id") != F.col("first")))
    to_first = large.select(F.col("first").alias("a"), F.col("set_id").alias("b"))
    even = lambda w: w if weighted else F.transform(w, lambda _: F.lit(1.0))
    total = lambda w: F.aggregate(w, F.lit(0.0), lambda s, y: s + y)

    def verified(candidates: DataFrame) -> DataFrame:
        left = hashed.select(F.col("set_id").alias("a"), F.col("h").alias("ha"), F.col("w").alias("wa"))
        right = hashed.select(F.col("set_id").alias("b"), F.col("h").alias("hb"), F.col("w").alias("wb"))
        both = candidates.distinct().join(left, "a").join(right, "b")
        if weighted:
            of = F.map_from_arrays("hb", "wb")
            shared = F.aggregate(F.arrays_zip("ha", "wa"), F.lit(0.0), lambda s, z: s + F.least(z.wa, F.coalesce(F.try_element_at(of, z.ha), F.lit(0.0))))
            ratio = shared / (total(F.col("wa")) + total(F.col("wb")) - shared)
        else:
            shared = F.size(F.array_intersect("ha", "hb")).cast("double")
            ratio = shared / (F.size("ha") + F.size("hb") - shared)
        return both.select("a", "b", ratio.alias("similarity")).where(F.col("similarity") >= threshold - 1e-12)

    close = cut_lineage(verified(pairs.union(to_first)))
    apart = large.select("key", F.col("first").alias("a"), F.col("set_id").alias("b")).join(close, ["a", "b"], "left_anti").select("key", F.col("b").alias("x"))
    if apart.isEmpty():
        return close
    # the leading shingles before which at most 1 - threshold of a set's weight lies: what follows is too little for a link
    weights = even(F.col("w"))
    leading = F.aggregate(
        weights, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("k")),
        lambda s, w: F.struct((s["sum"] + w).alias("sum"), (s["k"] + F.when(s["sum"] <= (1 - threshold) * total(weights) + 1e-9, 1).otherwise(0)).alias("k")),
    )["k"]
    prefixes = hashed.select("set_id", F.slice("h", F.lit(1), leading).alias("p"))
    wanted = apart.select("key").distinct()
    theirs = large.join(wanted, "key", "left_semi").join(prefixes, "set_id").select("key", F.explode("p").alias("h"), F.col("set_id").alias("y"))
    ours = apart.join(prefixes.withColumnRenamed("set_id", "x"), "x").select("key", F.explode("p").alias("h"), "x")
    met = ours.join(theirs, ["key", "h"]).where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return close.union(verified(met))


def near_duplicate_groups(
    records: DataFrame, record_id: str, shingles: Column, *, threshold: float = 0.8, same_key: Column | None = None, weighted: bool = False, alone: bool = False
) -> DataFrame:
    """``(record_id, grp)`` for every record that is linked to another; grp is the least record of its group. alone: with a row
    for each record that is linked to none, too, a group of its own.

    Two records are linked when their shingle sets are at least ``threshold`` alike, or when their ``same_key`` is equal and
    not empty; groups are records linked directly or through others. Records with equal sets are one set throughout and never expanded into pairs.

    Null ids give no rows. Records without shingles are linked by their key only. Repeated rows count once. An empty table
    gives none. Other columns are ignored, whatever their names.
    """
    base = records.select(
        F.col(record_id).cast("long").alias("_id"), F.transform(shingles, lambda s: F.xxhash64(s)).alias("_sh"), (same_key if same_key is not None else F.lit(None).cast("string")).alias("_key")
    )
    base = cut_lineage(base.where(F.col("_id").isNotNull()).dropDuplicates(["_id", "_sh", "_key"]))  # texts and addresses are parsed once
    with_words = base.where(F.size("_sh") > 0)
    sets = with_words.groupBy(F.col("_sh").alias("shingles")).agg(F.min("_id").alias("set_id"))
    close = linked_sets(sets, threshold, weighted=weighted)
    copies = with_words.join(sets.withColumnRenamed("shingles", "_sh"), "_sh").select(F.col("set_id").alias("a"), F.col("_id").alias("b")).where("a != b")
    keyed = base.where(F.coalesce(F.col("_key") != "", F.lit(False)))
    firsts = keyed.groupBy("_key").agg(F.min("_id").alias("a"), F.max("_id").alias("z")).where("a != z").select("_key", "a")
    same = keyed.join(firsts, "_key").select("a", F.col("_id").alias("b")).where("a != b")
    links = close.select("a", "b").union(copies).union(same)
    groups = connected(links, "a", "b")
    if alone:
        groups = base.select(F.col("_id").alias("node")).distinct().join(groups, "node", "left").withColumn("grp", F.coalesce("grp", "node"))
    return groups.select(F.col("node").alias(record_id), "grp")
