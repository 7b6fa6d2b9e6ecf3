"""Operator 13, centroid clustering in whole numbers, by DataFrame expressions alone.

Vectors become arrays of whole numbers, stored once. In each round the centroids are literal
arrays: ``zip_with`` and ``aggregate`` give the squared distance to each of them, the least struct
of distance and number chooses the cluster, and one sum per component, combined on the map side,
gives the next centroids. What returns to the driver in a round is one row per cluster, so its size
depends on the number of clusters and components, not on the vectors.

Only vectors with exactly ``size`` components, none null or non-finite, are kept; others have no
row. The centroids start as the kept vectors with the smallest digest of their id; a null id comes
last, and vectors of one id come by their components. Fewer vectors than clusters give fewer
centroids. Rows are vectors one by one, also repeated ones. Other columns are not read; an empty
table gives an empty result. Components must lie within +-131,072 times 1,024 / ``scale``, so that
distances of up to 128 components fit in 64 bits; a larger one makes the query fail rather than
give a wrong distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import Stored

Centroid = list[int]
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and floor(scale * x) of every vector that is kept."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))

    def whole(v: Column) -> Column:
        scaled = v.cast("double") * scale
        too_large = F.raise_error(F.lit("a component is too large for exact distances")).cast("long")
        return F.when(F.abs(scaled) <= LARGEST, F.floor(scaled)).otherwise(too_large)

    kept = vectors.select("vec_id", "embedding").where((F.size(x) == size) & finite)
    return kept.select("vec_id", F.transform(x, whole).alias("values"))


def literal(centroid: Centroid) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in centroid])


def squared_distance(values: Column, centroid: Centroid) -> Column:
    squares = F.zip_with(values, literal(centroid), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)


def nearest(values: Column, centroids: Sequence[Centroid]) -> Column:
    """The distance and number of the nearest centroid; of equally near ones the smaller number."""
    return F.array_min(
        F.array(*[
            F.struct(squared_distance(values, c).alias("distance"), F.lit(k).alias("cluster"))
            for k, c in enumerate(centroids)
        ])
    )


def floor_div(total: Column, n: Column) -> Column:
    """The exact quotient of whole numbers, rounded down."""
    return F.call_function("div", total - F.pmod(total, n), n)


def first_centroids(kept: DataFrame, clusters: int, seed: str) -> list[Centroid]:
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "values").limit(clusters)
    return [list(row["values"]) for row in first.select("values").collect()]


def next_centroids(kept: DataFrame, centroids: list[Centroid]) -> list[Centroid]:
    """Every non-empty centroid becomes the floor of its vectors' mean."""
    assigned = kept.select(nearest(F.col("values"), centroids)["cluster"].alias("cluster"), "values")
    n = F.count(F.lit(1))
    means = [floor_div(F.sum(F.col("values")[i]), n) for i in range(len(centroids[0]))]
    out = list(centroids)
    for row in assigned.groupBy("cluster").agg(F.array(*means).alias("mean")).collect():
        out[row["cluster"]] = list(row["mean"])
    return out


def cluster_vectors(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: str = "3:"
) -> tuple[DataFrame, list[Centroid]]:
    """vec_id, cluster and distance of every kept vector, and the final centroids."""
    kept = Stored(whole_vectors(vectors, size, scale), "whole-vectors").df
    centroids = first_centroids(kept, clusters, seed)
    if not centroids:
        none = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none.where(F.lit(False)), []
    for _ in range(rounds):
        following = next_centroids(kept, centroids)
        if following == centroids:
            break  # every later round would be the same
        centroids = following
    best = nearest(F.col("values"), centroids).alias("best")
    assigned = kept.select("vec_id", best).select("vec_id", "best.cluster", "best.distance")
    return Stored(assigned, "assigned-vectors").df, centroids


def centroid_digest(centroid: Centroid) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_report(vectors: DataFrame, **parameters) -> DataFrame:
    """vec_id, cluster, distance, the summed distances of the cluster and of all, a centroid digest."""
    assigned, centroids = cluster_vectors(vectors, **parameters)
    sums = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}

    def of_cluster(per_cluster: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in per_cluster or [None]]), F.col("cluster") + 1)

    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([sums.get(k, 0) for k in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        of_cluster(list(map(centroid_digest, centroids)), "string").alias("centroid_sha256"),
    )


def cluster_sql(clusters: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: str = "3:") -> str:
    """The report over ``embeddings`` in SQL, one group of steps for each round."""
    steps = [f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT rid, unnest(range(1, {size} + 1)) AS i, unnest(v) AS x FROM kept
), centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS c, v
    FROM kept QUALIFY c < {clusters}
)"""]  # fmt: skip
    for k in range(rounds + 1):
        steps.append(f"""far{k} AS MATERIALIZED (
    SELECT p.rid, q.c, sum((p.x - q.y) * (p.x - q.y))::BIGINT AS d
    FROM parts p JOIN (SELECT c, unnest(range(1, {size} + 1)) AS i, unnest(v) AS y FROM centroids{k}) q USING (i)
    GROUP BY p.rid, q.c
), near{k} AS MATERIALIZED (
    SELECT rid, c, d FROM far{k} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1
)""")
        if k < rounds:
            steps.append(f"""means{k} AS MATERIALIZED (
    SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM near{k} JOIN parts USING (rid) GROUP BY c, i
), centroids{k + 1} AS MATERIALIZED (
    SELECT c, coalesce(m.v, o.v) AS v
    FROM centroids{k} o
    LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM means{k} GROUP BY c) m USING (c)
)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance,
    sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(v, ',')) AS centroid_sha256
FROM near{rounds} JOIN (SELECT rid, vec_id FROM kept) USING (rid) JOIN centroids{rounds} USING (c)"""


CLUSTER_SQL = cluster_sql()
