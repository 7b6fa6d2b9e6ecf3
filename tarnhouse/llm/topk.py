"""Operator 9, exact top-k inner products, block at a time.

Vectors become whole numbers and lie in blocks of consecutive ids, each with the largest and the
smallest value of every component. A query's bound for a block is the sum, over components, of
the most that the block can add. Blocks are scored in falling order of their bounds until the
next bound is below the k-th best score, so the result is exact.

The query set meets the blocks in groups: groups of queries are sent to shards of blocks, and
each pair is one bounded task. In a first round each shard scores only the best block of each
query; the k-th best of these scores bounds the second round in every shard.

Vectors that are null or hold null or non-finite components take no part. Queries meet vectors
of their own length. A null id is no query, and as a candidate it comes last among ties. Rows
are candidates one by one, also repeated ones; a query leaves out its own row only. Other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnhouse.llm.common import Stored, shuffle_width

BLOCKS = "shard int, size int, rids binary, ids binary, no_id binary, values binary, most binary, least binary"
QUERIES = "part int, size int, rids binary, ids binary, values binary, floors binary"
SCORES = "query_rid long, query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """rid, vec_id and floor(scale * x) of every vector that takes part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "embedding").where(finite).select(
        "rid", "vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("values")
    )


def packed_blocks(vectors: DataFrame, block_size: int, shard_blocks: int, n_parts: int) -> DataFrame:
    """Blocks of consecutive ids with the extremes of their components, dealt to shards."""

    def blocks(batches):
        waiting = None
        for batch in batches:
            waiting = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            if len(waiting) >= block_size * shard_blocks:
                yield from cut(waiting)
                waiting = None
        if waiting is not None and len(waiting):
            yield from cut(waiting)

    def cut(rows: pd.DataFrame):
        out = []
        for size, own in rows.groupby(rows["values"].map(len), sort=True):
            for a in range(0, len(own), block_size):
                part = own.iloc[a : a + block_size]
                m = np.array(part["values"].tolist(), dtype=np.int64).reshape(len(part), size)
                ids, rids = part["id_or_zero"].to_numpy(np.int64), part["rid"].to_numpy(np.int64)
                out.append((
                    int(part["shard"].iloc[0]), int(size), rids.tobytes(), ids.tobytes(),
                    part["no_id"].to_numpy(bool).tobytes(), m.tobytes(),
                    m.max(axis=0).tobytes(), m.min(axis=0).tobytes(),
                ))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in BLOCKS.split(", ")])

    ordered = vectors.repartitionByRange(n_parts, "vec_id", "rid").sortWithinPartitions("vec_id", "rid")
    return ordered.select(
        "rid",
        F.coalesce("vec_id", F.lit(0)).alias("id_or_zero"),
        F.col("vec_id").isNull().alias("no_id"),
        "values",
        F.spark_partition_id().alias("shard"),
    ).mapInPandas(blocks, BLOCKS)


def packed_queries(queries: DataFrame, part_queries: int) -> DataFrame:
    """Groups of about ``part_queries`` queries of one length; ``floor`` is a score to reach."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = np.array(rows["values"].tolist(), dtype=np.int64)
        arrays = [rows[c].to_numpy(np.int64).tobytes() for c in ("rid", "vec_id")]
        return pd.DataFrame(
            [(key[0], key[1], *arrays, values.tobytes(), rows["floor"].to_numpy(np.int64).tobytes())],
            columns=[c.split()[0] for c in QUERIES.split(", ")],
        )

    n_parts = max(1, -(-queries.count() // part_queries))
    part = F.pmod(F.xxhash64("rid"), F.lit(n_parts)).cast("int")
    keyed = queries.select("*", part.alias("part"), F.size("values").alias("size"))
    return keyed.groupBy("part", "size").applyInPandas(pack, QUERIES)


def product(m: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where all sums are small enough to be exact."""
    most = float(np.abs(m).max(initial=0)) * float(np.abs(q).max(initial=0)) * m.shape[-1]
    if most < 2**53:
        return (m.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return np.array(m.astype(object) @ q.astype(object), dtype=np.int64)


def score_pair(blocks: pd.DataFrame, queries: pd.DataFrame, k: int, best_only: bool) -> pd.DataFrame:
    """The k best of one shard for each query of one group, block at a time."""
    found = []
    for size, own in blocks.groupby("size"):
        asked = queries[queries["size"] == size]
        if asked.empty:
            continue
        size = int(size)
        read = lambda rows, c, kind="i8": [np.frombuffer(x, dtype=kind) for x in rows[c]]
        matrices = [v.reshape(-1, size) for v in read(own, "values")]
        ids, rids, no_id = read(own, "ids"), read(own, "rids"), read(own, "no_id", "?")
        most = np.array(read(own, "most")).reshape(-1, size)
        least = np.array(read(own, "least")).reshape(-1, size)
        q_all = np.concatenate(read(asked, "values")).reshape(-1, size)
        q_rid, q_id, floor = (np.concatenate(read(asked, c)) for c in ("rids", "ids", "floors"))
        # What a block can reach: its largest values where the query is positive, else its smallest.
        bounds = product(np.maximum(q_all, 0), most.T) + product(np.minimum(q_all, 0), least.T)
        for i, q in enumerate(q_all):
            best: list[tuple[int, bool, int]] = []
            kth = int(floor[i])
            for b in np.argsort(-bounds[i], kind="stable"):
                if bounds[i, b] < kth:
                    break
                scores = product(matrices[b], q)
                take = (scores >= kth) & (rids[b] != q_rid[i])
                new = zip((-scores[take]).tolist(), no_id[b][take].tolist(), ids[b][take].tolist(), strict=True)
                best = sorted([*best, *new])[:k]
                if len(best) == k:
                    kth = max(kth, -best[-1][0])
                if best_only:
                    break
            found += [(q_rid[i], q_id[i], None if missing else v, -s) for s, missing, v in best]
    out = pd.DataFrame(found, columns=[c.split()[0] for c in SCORES.split(", ")])
    return out.astype({"vec_id": "Int64"})


def top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    block_size: int = 64,
    shard_blocks: int = 64,
    part_queries: int = 2048,
) -> DataFrame:
    """The k highest inner products of each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``. ``block_size`` vectors make a
    block, a shard has about ``shard_blocks`` of them and a group about ``part_queries`` queries.
    """
    spark = vectors.sparkSession
    whole = Stored(whole_numbers(vectors, scale), "topk-vectors").df
    n_shards = max(1, -(-whole.count() // (block_size * shard_blocks)))
    blocks = Stored(packed_blocks(whole, block_size, shard_blocks, n_shards), "topk-blocks").df
    queries = whole.where(F.col("vec_id") % every == 0)

    def scored(asked: DataFrame, best_only: bool) -> DataFrame:
        packed = packed_queries(asked, part_queries)
        n_parts = max(1, -(-asked.count() // part_queries))
        left = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"))
        shards = F.explode(F.sequence(F.lit(0), F.lit(shard_count - 1)))
        right = packed.select("*", shards.alias("shard"))

        def pair(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            return score_pair(b, q, k, best_only)

        return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(pair, SCORES)

    shard_count = max(n_shards, shuffle_width(spark))  # range partitions are numbered below this
    lowest = F.lit(-(2**63) + 1).cast("long")
    first = scored(queries.withColumn("floor", lowest), best_only=True)
    kth = (
        best_of(first, k).groupBy("query_rid").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(f"n = {k}")
    )
    floors = queries.join(kth, queries["rid"] == kth["query_rid"], "left").select(
        "rid", "vec_id", "values", F.coalesce("kth", lowest).alias("floor")
    )
    floors = Stored(floors, "topk-floors").df
    return best_of(scored(floors, best_only=False), k).select("query_id", "rank", "vec_id", "score")


def best_of(scores: DataFrame, k: int) -> DataFrame:
    by_score = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return scores.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
