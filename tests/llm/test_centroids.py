"""Operator 13 against brute force and its SQL."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest

from tarnhouse.llm.centroids import cluster_report, cluster_sql

from .conftest import stored

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int, values string"


def clusters_by_hand(rows, clusters, rounds, size):
    kept = [
        (v, [math.floor(1024 * x) for x in e])
        for v, e in rows
        if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e)
    ]
    digest = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [r[1] for r in sorted(kept, key=digest)[:clusters]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near = assign()
    total = Counter()
    for d, k in near:
        total[k] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        repr((v, k, d, total[k], sum(total.values()), name[k])) for (v, _), (d, k) in zip(kept, near, strict=True)
    )


def some_rows(n):
    rng = np.random.default_rng(8)
    rows = [(int(k), [float(x) for x in (rng.normal(size=4) + k % 3).astype("f4")]) for k in range(n)]
    if n > 5:
        rows += [(None, rows[3][1]), (None, [0.5] * 4), (900, None), (901, [1.0, None, 1.0, 1.0]), (902, [float("nan")] * 4)]
        rows += [(903, [float("inf")] * 4), (904, [1.0, 2.0]), (905, []), rows[2], rows[2], (2, [0.25] * 4)]
        rows += [(1000 + k, [-0.0005, 0.0, 0.5, -1.5]) for k in range(40)]  # ties, negative fractions
    return rows


@pytest.mark.parametrize("n", [0, 3, 200])
def test_clusters(spark, tmp_path, n):
    rows = some_rows(n)
    table = stored(spark, tmp_path, [(*r, "c", 1, "v") for r in rows], SCHEMA, "vectors")
    got = cluster_report(table, clusters=5, rounds=4, size=4)
    assert got.columns == COLUMNS
    found = sorted(repr(tuple(r)) for r in got.collect())
    assert found == clusters_by_hand(rows, 5, 4, 4)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/vectors/*.parquet'")
    by_sql = con.execute(cluster_sql(5, 4, 4)).fetchall()
    assert sorted(map(repr, by_sql)) == found


def test_copies_share_a_centroid(spark, tmp_path):
    """All vectors alike: equal centroids, of which the first takes all and the others stay."""
    rows = [(k, [1.0, 2.0], "c", 1, "v") for k in range(50)]
    got = cluster_report(stored(spark, tmp_path, rows, SCHEMA, "copies"), clusters=3, rounds=2, size=2).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)} and len(got) == 50


def test_a_component_too_large_fails(spark, tmp_path):
    rows = [(1, [3e38, 0.0], "c", 1, "v"), (2, [3e38, 0.0], "c", 1, "v")]
    with pytest.raises(Exception, match="too large"):
        cluster_report(stored(spark, tmp_path, rows, SCHEMA, "large"), clusters=1, rounds=1, size=2).collect()
