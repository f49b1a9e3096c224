"""Shards of near equal bytes by sampled splitters.

Records are ordered by a hash of their text.  Keys are drawn with chances in
proportion to the records' sizes; evenly spaced drawn keys are the
boundaries of many small ranges, and a range found too full by its exact size
is drawn from again and subdivided.  Consecutive ranges fill the shards.
Texts of one key lie in one range, so equal texts share a shard; only a key
that outweighs a whole shard is subdivided, by ranges of its document ids'
hash.  Keys of at least a sixteenth of a shard are placed first, largest to
the emptiest shard, and the ranges fill what they leave.

The driver holds the sampled keys, the boundaries and the ranges' sizes, whose
number follows from the parameters; the records stay distributed, and slots
are numbered range by range.

Defined cases: a null text has size 0 + 16, crc 0 and the key of the empty
text; null ids come first in a range; repeated rows are interchangeable and
get different slots; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, id_text

OVERHEAD = 16
RANGES_PER_SHARD = 64
DRAWN_PER_RANGE = 16
ROWS_PER_RANGE = 1_000_000
HEAVY = 16               # a key of 1 / HEAVY of a shard or more is placed on its own


def records(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return id_text(docs).select("doc_id", (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
                                F.crc32(raw).cast("long").alias("text_crc32"), F.xxhash64(raw).alias("key"))


def _drawn(rows: DataFrame, chance: float, seed: int) -> np.ndarray:
    """Keys drawn with a chance of ``chance`` per byte, by a hash of key and id: reruns draw alike."""
    u = (F.xxhash64("key", "doc_id", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1))) / float(1 << 53)
    picked = rows.filter(u < F.col("size") * F.lit(chance)).select("key").toArrow()
    return np.unique(picked["key"].to_numpy())


def _with_range(rows: DataFrame, bounds: np.ndarray, heavy: dict[int, int], pieces: np.ndarray) -> DataFrame:
    """Adds ``unit``: the range of the key, or a negative number for each piece of a heavy key."""
    hk = np.array(sorted(heavy), np.int64)
    first = np.concatenate([[0], np.cumsum(pieces)])[:-1] if len(hk) else np.zeros(0, np.int64)

    def run(batches):
        for b in batches:
            key = b.column(3).to_numpy()
            unit = np.searchsorted(bounds, key, "right").astype(np.int64)
            if len(hk):
                at = np.minimum(np.searchsorted(hk, key), len(hk) - 1)
                mine = hk[at] == key
                h = b.column(4).to_numpy().astype(np.uint64) >> np.uint64(32)
                piece = (h * pieces[at].astype(np.uint64)) >> np.uint64(32)
                unit = np.where(mine, -1 - first[at] - piece.astype(np.int64), unit)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(unit)], ["doc_id", "size", "text_crc32", "key", "unit"])

    return rows.withColumn("h", F.xxhash64("doc_id", "key")).select("doc_id", "size", "text_crc32", "key", "h") \
        .mapInArrow(run, "doc_id long, size long, text_crc32 long, key long, unit long")


def _sizes(ranged: DataFrame) -> dict[int, tuple[int, int, int]]:
    t = ranged.groupBy("unit").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"),
                                   F.min("key").alias("lo"), F.max("key").alias("hi")).toArrow().to_pylist()
    return {r["unit"]: (r["s"], r["n"], r["hi"] - r["lo"]) for r in t}


def place(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Unit -> shard: heavy pieces (negative units) to the emptiest shard, then ranges in order up to a common level."""
    load = np.zeros(shards)
    out: dict[int, int] = {}
    for u in sorted((u for u in sizes if u < 0), key=lambda u: (-sizes[u], u)):
        s = int(load.argmin())
        out[u] = s
        load[s] += sizes[u]
    light = sorted(u for u in sizes if u >= 0)
    total = sum(sizes[u] for u in light)
    # the level that the ranges raise every shard to, as water fills a vessel of uneven floor
    floor = np.sort(load)
    level = next(lv for k in range(shards, 0, -1) if (lv := (total + floor[:k].sum()) / k) >= floor[k - 1])
    room = np.cumsum(np.maximum(level - load, 0))
    done = 0.0
    for u in light:
        out[u] = min(int(np.searchsorted(room, done + sizes[u] / 2, "right")), shards - 1)
        done += sizes[u]
    return out


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, key, shard, slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    rows = cut_lineage(records(docs))
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not n:
        return rows.select("doc_id", "size", "text_crc32", "key", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    target = total / shards
    by_key = rows.groupBy("key").agg(F.sum("size").alias("s")).filter(F.col("s") * HEAVY >= target)
    heavy = {r["key"]: r["s"] for r in by_key.collect()}           # at most HEAVY * shards keys
    pieces = np.array([math.ceil(4 * heavy[k] / target) if heavy[k] > target else 1 for k in sorted(heavy)], np.int64)
    light = rows.join(F.broadcast(spark.createDataFrame([(k,) for k in heavy], "key long")), "key", "left_anti") if heavy else rows
    ranges = max(RANGES_PER_SHARD * shards, math.ceil(n / ROWS_PER_RANGE))
    drawn = _drawn(light, ranges * DRAWN_PER_RANGE / total, 0)
    bounds = drawn[DRAWN_PER_RANGE // 2::DRAWN_PER_RANGE]
    most, step = 4 * total / ranges, 0
    while True:
        ranged = _with_range(rows, bounds, heavy, pieces)
        sizes = _sizes(ranged)
        full = [u for u, (s, _, width) in sizes.items() if u >= 0 and s > most and width > 0]
        if not full:
            break
        step += 1
        inside = ranged.filter("unit >= 0").join(F.broadcast(spark.createDataFrame([(u,) for u in full], "unit long")), "unit", "left_semi")
        bounds = np.union1d(bounds, _drawn(inside, ranges * 2 ** step / total, step))
    to = place({u: s for u, (s, _, _) in sizes.items()}, shards)
    start, offset = [0] * shards, {}
    for u in sorted(sizes):
        offset[u] = start[to[u]]
        start[to[u]] += sizes[u][1]
    plan = spark.createDataFrame([(u, to[u], offset[u]) for u in sizes], "unit long, shard int, offset long")
    along = Window.partitionBy("unit").orderBy("key", "doc_id")
    return ranged.withColumn("i", F.row_number().over(along)).join(F.broadcast(plan), "unit") \
                 .select("doc_id", "size", "text_crc32", "key", "shard", (F.col("offset") + F.col("i") - 1).alias("slot"))


def op3_sharding(spark, sf_dir) -> DataFrame:
    return shard(documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                                  F.lit(None).cast("int").alias("grown_shard"))


ORACLE_SQL = None
