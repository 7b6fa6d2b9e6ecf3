"""Operator 8, MinHash near-dedup by a chosen-path similarity join.

Documents with the same shingle set are one node from the start. Nodes carry a MinHash signature. In
each of several independent trees a node follows a path of a few coordinates, each of which the path
so far chooses, and nodes with the same tokens on the way are a group. Groups of up to ``small`` nodes
after ``FIRST`` coordinates are compared as they are; larger ones go on to ``depth`` coordinates. There
are so many trees that a pair at the threshold meets with probability ``recall`` even there; after
``FIRST`` coordinates twelve trees miss it with probability 2e-7.

Inside a block of a group, signatures tell which nodes are alike; those that hang together are a
cluster, and a cluster that several trees find is kept once. Then the full sets of each cluster are
compared where they meet, and a block emits no more links than join its nodes. So no pair becomes a
row, however many are alike, and the rows grow with the number of nodes.

Groups that are still large are cut into parts for this, in each tree in another way. After that,
those within one component are settled, as no link in them could change anything. The others, of which
groups with mostly the same nodes are united, are dealt to blocks in which all pairs between their
components meet. Nothing is capped, and no group is gathered in one task.

A null or empty text, or one without words, has no shingles and no link. Rows are documents one
by one: repeated rows are exact copies, and rows with a null id take part, their component being
the smallest id reached, or null. Other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.llm.common import Stored, free_name, measured, numbered, release
from tarnhouse.llm.components import components

COORDINATES = 128
SEED = 20240229


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Shingles:
    """Hashed shingle sets; equal words always hash alike, in every task."""

    def __init__(self, size: int, cache_words: int = 30_000):
        import xxhash

        rng = np.random.default_rng(SEED)
        self.size, self.limit, self.words = size, cache_words, {}
        self.hash = xxhash.xxh64_intdigest
        self.factors = rng.integers(0, 1 << 63, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.coordinates = rng.integers(0, 1 << 63, size=COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, text: str) -> np.ndarray:
        """The sorted distinct hashes of a text's shingles."""
        # On bytes, lower() and split() know A-Z and the six ASCII blanks only, as wanted here.
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(self.words) > self.limit:
            self.words.clear()
        known = self.words
        for w in words:
            if w not in known:
                known[w] = self.hash(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        if len(h) < self.size:
            whole = np.uint64(len(h))
            for x in h:
                whole = mixed(np.array([whole]) ^ x)[0]
            return np.array([whole], dtype=np.uint64)
        n = len(h) - self.size + 1
        total = np.zeros(n, dtype=np.uint64)
        for k, factor in enumerate(self.factors):
            total += mixed(h[k : k + n] * factor)
        return np.unique(mixed(total))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
        for a in range(0, len(shingles), 2048):
            np.minimum(least, (shingles[a : a + 2048, None] * self.coordinates).min(axis=0), out=least)
        return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


@contextmanager
def small_batches(spark: SparkSession, batch_bytes: int = 4 << 20) -> Iterator[None]:
    """Texts and sets go to Python in smaller batches, as Spark, Arrow and pandas each hold a copy of one."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def profiles(docs: DataFrame, row: str, size: int) -> DataFrame:
    """rid, doc_id, n_shingles, two hashes of the whole set, and the signature."""

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(size)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                own = shingles.of(text)
                with np.errstate(over="ignore"):
                    whole = [int(x) for x in np.array([own.sum(), mixed(own).sum()], dtype=np.uint64).view(np.int64)]
                rows.append((len(own), *whole, shingles.signature(own) if len(own) else None))
            out = pd.DataFrame(rows, columns=["n_shingles", "set1", "set2", "signature"])
            yield pd.concat([batch[["rid", "doc_id"]].reset_index(drop=True), out], axis=1)

    keyed = docs.select(
        F.col(row).alias("rid"),
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no null in whole numbers
        F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = "rid long, doc_id string, n_shingles long, set1 long, set2 long, signature array<int>"
    return keyed.mapInPandas(profile, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def shingle_sets(docs: DataFrame, row: str, nodes: DataFrame, size: int) -> DataFrame:
    """The full sets of the given nodes, from their representative rows."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(size)
        for batch in batches:
            own = [shingles.of(t).view(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "shingles": own})

    keyed = docs.select(F.col(row).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    return keyed.join(nodes, "node", "left_semi").mapInPandas(sets, "node long, shingles array<long>")


FIRST = 2  # coordinates after which small groups are compared
IN_BLOCK = 768  # nodes of a large group that are compared with as many others in one task
IN_NODE = 5000  # shingles on average from which a node counts as several in this


def trees_for(threshold: float, depth: int, recall: float) -> int:
    """How many trees find a pair at the threshold with this probability, after so many coordinates."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))


def path_below(path: Column, steps: int) -> Column:
    """The path that the row's signature follows from ``path`` on, each coordinate chosen by the path so far."""
    place = lambda p: F.pmod(F.xxhash64(p), F.lit(COORDINATES)).cast("int")
    if steps < 1:
        return path
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), path, lambda p, _: F.xxhash64(p, F.get("signature", place(p)))
    )


def sized(members: DataFrame) -> DataFrame:
    """The members (path, node, n_shingles) of groups of several nodes, with the size of their group."""
    heavy = F.ceil(F.sum("n_shingles") / IN_NODE).cast("long")
    groups = members.groupBy("path").agg(F.count("*").alias("nodes"), F.greatest(F.count("*"), heavy).alias("n"))
    return members.join(groups.where("nodes > 1").select("path", "n"), "path")


class Forest:
    """The groups of all trees, as stored tables of (path, node, n_shingles, n): small ones, and large ones."""

    def __init__(self, nodes: DataFrame, trees: int, small: int, depth: int):
        self.nodes, first = nodes, min(FIRST, depth)
        roots = F.explode(F.sequence(F.lit(1), F.lit(trees)).cast("array<bigint>"))
        members = nodes.select("node", "n_shingles", "signature", roots.alias("root"))
        members = members.select("node", "n_shingles", path_below(F.col("root"), first).alias("path"))
        found = Stored(sized(members), "forest")
        self.stored, self.small = [found], found.df.where(F.col("n") <= small)
        large = found.df.where(F.col("n") > small)
        self.large = None if large.isEmpty() else large
        if self.large is not None and depth > first:
            members = large.select("path", "node").join(nodes, "node")
            members = members.select("node", "n_shingles", path_below(F.col("path"), depth - first).alias("path"))
            deeper = Stored(sized(members), "forest-deeper")
            self.stored.append(deeper)
            self.small = self.small.unionByName(deeper.df.where(F.col("n") <= small))
            large = deeper.df.where(F.col("n") > small)
            self.large = None if large.isEmpty() else large

    def clusters(self, least: int) -> DataFrame:
        """cluster and node of nodes that are alike by signature in a small group or a part of a large one.

        A cluster is named by its nodes, so that it is one row for each of them in whatever trees it is found.
        """
        blocks = self.small.select("path", F.lit(0).alias("part"), "node")
        if self.large is not None:
            part = F.pmod(F.xxhash64("path", "node"), parts("n")).cast("int")
            blocks = blocks.unionByName(self.large.select("path", part.alias("part"), "node"))
        blocks = blocks.join(self.nodes.select("node", "signature"), "node")
        blocks = blocks.select(F.xxhash64("path", "part").alias("block"), "node", "signature")

        def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch, bounds in whole_groups(batches, "block"):
                node, signature = batch["node"].to_numpy(), np.stack(batch["signature"].to_numpy())
                out = []
                for a, b in bounds:
                    own = np.sort(node[a:b])
                    labels = np.arange(b - a)
                    for left, right in alike_in_block(node[a:b], node[a:b], signature[a:b], least):
                        labels = joined(labels, np.searchsorted(own, left), np.searchsorted(own, right))
                    names = np.zeros(b - a, dtype=np.uint64)
                    np.add.at(names, labels, mixed(own.view(np.uint64)))
                    several = np.bincount(labels, minlength=b - a)[labels] > 1
                    out.append(np.stack([names[labels].view(np.int64), own], axis=1)[several])
                yield pd.DataFrame(np.concatenate(out), columns=["cluster", "node"])

        dealt = blocks.repartition("block").sortWithinPartitions("block")
        return dealt.mapInPandas(alike, "cluster long, node long").distinct()

    def blocks_between(self, labels: DataFrame) -> DataFrame:
        """cluster, node and component of the large groups that are not settled, by block of about 2 * IN_BLOCK.

        They are dealt so that all pairs between components meet, but not those within the
        largest: the rows grow with the number of nodes outside it.
        """
        crowd = united_further(self.large.select("path", "node"))
        members = crowd.df.join(self.nodes.select("node", "n_shingles"), "node")
        weights = members.groupBy("path").agg(F.greatest(F.lit(1.0), F.avg("n_shingles") / IN_NODE).alias("weight"))
        known = Stored(with_components(crowd.df, labels), "crowd-large")
        rest = Stored(known.df.join(group_shapes(known.df).join(weights, "path"), "path"), "crowd-rest")
        crowd.remove()
        known.remove()
        self.stored.append(rest)
        number = lambda n: parts(F.col(n) * F.col("weight"))
        upto = lambda n: F.sequence(F.lit(0), number(n) - 1)
        part = lambda n: F.pmod(F.xxhash64("node"), number(n)).cast("int")
        main, others = rest.df.where("component = main"), rest.df.where("component <> main")
        others = others.withColumn("own", part("other_n"))
        out = main.withColumn("p", F.explode(upto("other_n"))).withColumn("q", -1 - part("main_n"))
        keys = ["path", "p", "q", "node", "component"]
        out = out.select(*keys)
        across = others.withColumn("p", F.col("own")).withColumn("q", F.explode(upto("main_n")))
        out = out.unionByName(across.withColumn("q", -1 - F.col("q")).select(*keys))
        among = others.withColumn("other", F.explode(upto("other_n")))
        among = among.withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))
        out = out.unionByName(among.select(*keys))
        return out.select(F.xxhash64("path", "p", "q").alias("cluster"), "node", "component")

    def remove(self) -> None:
        for stored in self.stored:
            stored.remove()


def parts(n: Column | str) -> Column:
    n = F.col(n) if isinstance(n, str) else n
    return F.ceil(n / IN_BLOCK).cast("int")


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[pd.DataFrame, list[tuple[int, int]]]]:
    """Rows sorted by a key, in batches that hold groups of equal keys whole, with the bounds of these."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        keys = batch[key].to_numpy()
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
        if len(firsts) > 1:
            yield batch, list(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True))
        held = batch.iloc[firsts[-1] :].copy() if len(firsts) else None
    if held is not None:
        yield held, [(0, len(held))]


def joined(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member reachable for each member, after the links of two parallel arrays of members."""
    while True:
        low = np.minimum(labels[left], labels[right])
        new = labels.copy()
        for end in (left, right):
            np.minimum.at(new, end, low)
            np.minimum.at(new, labels[end], low)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def links_in_block(
    component: np.ndarray, sets: list[np.ndarray], percent: int, step: int = 1024
) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of different components, as pairs of members, as many as join what the full sets link.

    Each member meets the lists of members that hold its shingles; shingles of one member are left out.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets])
    _, shingle, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(n), sizes)
    several = holders[shingle] > 1
    shingle, member = shingle[several], member[several]
    lists = member[np.argsort(shingle, kind="stable")]
    starts = np.cumsum(holders * (holders > 1)) - holders * (holders > 1)
    own = np.concatenate([[0], np.cumsum(np.bincount(member, minlength=n))])
    _, labels = np.unique(component, return_inverse=True)
    before = labels
    for i in range(n - 1):
        if (labels[i + 1 :] == labels[i]).all():
            continue
        common = np.zeros(n, dtype=np.int64)
        for a in range(own[i], own[i + 1], step):
            held = shingle[a : min(a + step, own[i + 1])]
            lengths = holders[held]
            ends = np.cumsum(lengths)
            places = np.repeat(starts[held] - ends + lengths, lengths) + np.arange(ends[-1])
            common += np.bincount(lists[places], minlength=n)
        near = common * 100 >= (sizes[i] + sizes - common) * percent
        near[: i + 1] = False
        near &= labels != labels[i]
        if near.any():
            labels = np.where(np.isin(labels, labels[near]), labels[i], labels)
    # A star for each component that came about, of one member of each component before.
    _, firsts = np.unique(before, return_index=True)
    _, centres, which = np.unique(labels[firsts], return_index=True, return_inverse=True)
    centres = firsts[centres][which]
    moved = centres != firsts
    return centres[moved], firsts[moved]


def links_of(clusters: DataFrame, docs: DataFrame, row: str, size: int, percent: int) -> DataFrame:
    """a and b of links between the components of each cluster, as many as join what the full sets link."""
    sets = shingle_sets(docs, row, measured(clusters.select("node"), 24), size)
    rows = sets.join(measured(clusters, 40), "node").repartition("cluster").sortWithinPartitions("cluster")

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, bounds in whole_groups(batches, "cluster"):
            node, component, own = (batch[c].to_numpy() for c in ("node", "component", "shingles"))
            for a, b in bounds:
                left, right = links_in_block(component[a:b], list(own[a:b]), percent)
                if len(left):
                    yield pd.DataFrame({"a": node[a:b][left], "b": node[a:b][right]})

    return rows.mapInPandas(links, "a long, b long")


def alike_in_block(
    node: np.ndarray, component: np.ndarray, signature: np.ndarray, least: int, rows: int = 1 << 16
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a block's members, smaller node first, of different components and alike by signature."""
    order = np.argsort(node)
    node, component, signature = node[order], component[order], signature.reshape(len(node), -1)[order]
    left, right, size = [], [], 0
    for k in range(len(node) - 1):
        apart = np.flatnonzero((component[k + 1 :] != component[k]) & (node[k + 1 :] != node[k])) + k + 1
        near = apart[(signature[apart] == signature[k]).sum(axis=1) >= least]
        left.append(np.full(len(near), node[k]))
        right.append(node[near])
        size += len(near)
        if size >= rows or (size and k == len(node) - 2):
            yield np.concatenate(left), np.concatenate(right)
            left, right, size = [], [], 0


def at_home(groups: DataFrame) -> DataFrame:
    """path, node and the node's home, the largest of its groups; a node has a few in each tree."""
    own = groups.groupBy("node").agg(
        F.max(F.struct("n", "path"))["path"].alias("home"), F.collect_list("path").alias("paths")
    )
    return own.select("node", "home", F.explode("paths").alias("path"))


def group_shapes(rows: DataFrame) -> DataFrame:
    """path, largest component, its size and that of the rest, of groups that are not settled."""
    sizes = rows.groupBy("path", "component").agg(F.count("*").alias("n"))
    shape = sizes.groupBy("path").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.sum("n").alias("total"), F.count("*").alias("kinds")
    )
    return shape.where("kinds > 1").select(
        "path",
        F.col("largest.component").alias("main"),
        F.col("largest.n").alias("main_n"),
        (F.col("total") - F.col("largest.n")).alias("other_n"),
    )


def crowds(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """path and crowd of those of the groups that are mostly the same nodes as another.

    Groups of which three quarters have the same home are one crowd. Together they are at most so
    much larger than one of them that comparing all pairs once costs less than doing so in each.
    """
    homes = rows.groupBy("path", "home").agg(F.count("*").alias("n")).groupBy("path")
    homes = homes.agg(F.max(F.struct("n", "home")).alias("most"), F.sum("n").alias("total"))
    homes = homes.where("most.n * 4 >= total * 3").select("path", F.col("most.home").alias("crowd"))
    found = groups.select("path").join(homes, "path")
    several = found.groupBy("crowd").agg(F.count("*").alias("groups")).where("groups > 1").select("crowd")
    return found.join(several, "crowd", "left_semi").select("path", "crowd")


def members_of(rows: DataFrame, united: DataFrame) -> DataFrame:
    """path and node of the crowds, under paths of their own."""
    return rows.join(united, "path").select(F.xxhash64("crowd").alias("path"), "node").distinct()


def united_further(groups: DataFrame) -> Stored:
    """The crowds, of (path, node), with those united that are mostly the same nodes, until none are."""
    current = Stored(groups, "forest-crowd")
    while True:
        sizes = current.df.groupBy("path").agg(F.count("*").alias("n"))
        rows = at_home(current.df.join(sizes, "path"))
        united = Stored(crowds(rows, sizes), "forest-united").df
        if united.isEmpty():
            return current
        others = current.df.join(united, "path", "left_anti")
        following = Stored(others.unionByName(members_of(current.df, united)), "forest-crowd")
        current.remove()
        current = following


def with_components(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows without their sizes, with the component; a node without a label is its own component."""
    known = labels.withColumnRenamed("node", "labelled")
    joined = rows.join(known, rows["node"] == known["labelled"], "left")
    own = [c for c in ("path", "node", "home") if c in rows.columns]
    return joined.select(*own, F.coalesce("component", "node").alias("component"))


def merged(labels: Stored, links: DataFrame) -> Stored:
    """The components after more links: each component goes on as a star of its nodes."""
    if links.isEmpty():
        return labels
    stars = labels.df.select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(stars.unionByName(links))


def labelled(
    docs: DataFrame,
    percent: int = 85,
    shingle_words: int = 5,
    recall: float = 0.999,
    small: int = IN_BLOCK,
    depth: int = 5,
    margin: float = 0.15,
    row: str | None = None,
) -> DataFrame:
    """rid, doc_id, n_shingles, component (by a row number, its own without shingles) and component_id of each row.

    For the parameters see ``near_duplicates``.
    """
    spark = docs.sparkSession
    if row is None:
        row = free_name(docs, "row")
        docs = numbered(docs, row)
    threshold = percent / 100
    with small_batches(spark):
        rows = Stored(profiles(docs, row, shingle_words), "profiles")
    filled = rows.df.where("n_shingles > 0")
    classes = filled.groupBy("set1", "set2", "n_shingles").agg(
        F.min("rid").alias("node"),
        F.min("doc_id").alias("least_id"),
        F.first("signature").alias("signature"),
    )
    nodes = Stored(classes, "nodes")
    release(spark)
    forest = Forest(nodes.df.select("node", "n_shingles", "signature"), trees_for(threshold, depth, recall), small, depth)
    clusters = Stored(forest.clusters(int((threshold - margin) * COORDINATES)), "clusters")
    alone = clusters.df.withColumn("component", F.col("node"))
    with small_batches(spark):
        labels = components(links_of(alone, docs, row, shingle_words, percent))
    clusters.remove()
    if forest.large is not None:
        blocks = Stored(forest.blocks_between(labels.df), "blocks")
        with small_batches(spark):
            links = Stored(links_of(blocks.df, docs, row, shingle_words, percent), "links")
        labels = merged(labels, links.df)
        links.remove()
        blocks.remove()
    forest.remove()
    release(spark)

    keys = ["set1", "set2", "n_shingles"]
    own = nodes.df.select(*keys, "node", "least_id").join(labels.df, "node", "left")
    own = own.withColumn("component", F.coalesce("component", "node"))
    smallest = own.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = own.join(smallest, "component").select(*keys, "component", "component_id")
    out = rows.df.select("rid", "doc_id", *keys).join(known, keys, "left")
    single = F.col("n_shingles") == 0
    return out.select(
        "rid",
        "doc_id",
        "n_shingles",
        F.when(single, F.col("rid")).otherwise(F.col("component")).alias("component"),
        F.when(single, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """rid, doc_id, n_shingles, component_id and is_first of each row.

    Documents are linked if 100 * |intersection| >= ``percent`` * |union|. ``is_first`` marks one
    row of each component: the smallest id, then the first row. ``margin`` is how far below the
    threshold the share of equal coordinates may fall, over four standard deviations. There are
    as many trees as it takes for ``recall``, see ``trees_for``. ``row`` is the column that numbers
    the rows, see ``numbered``; without one they are numbered here.
    """
    out = labelled(docs, **parameters)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    chosen = out.groupBy("component", F.col("n_shingles") == 0).agg(F.min(order).alias("chosen"))
    chosen = chosen.select(F.col("chosen.rid").alias("rid"), F.lit(True).alias("is_first"))
    return out.join(chosen, "rid", "left").select(
        "rid", "doc_id", "n_shingles", "component_id", F.coalesce("is_first", F.lit(False)).alias("is_first")
    )


def near_report(docs: DataFrame, **parameters) -> DataFrame:
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return labelled(docs, **parameters).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """The documents without all but one of each group of near duplicates."""
    row = free_name(docs, "row")
    rows = numbered(docs, row)
    others = near_duplicates(rows, row=row, **parameters).where("NOT is_first").select(F.col("rid").alias(row))
    others = measured(Stored(others, "other-rows").df, 24)
    return rows.join(others, row, "left_anti").select(*docs.columns)
