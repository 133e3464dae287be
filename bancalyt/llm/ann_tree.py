"""Nearest neighbours by inner product through a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is filed under a leaf.
A query walks the tree best bin first: a priority queue holds the nodes seen
so far by an upper bound of the inner product in them (centroid, and radius
times the query's length), and the best one is opened next, until enough
leaves are visited. How many are enough is calibrated: the number is widened
until sample queries that the tree was not fitted on reach the target recall.
Equal vectors are one item, with the smallest of their ids.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bancalyt.llm.common import materialize, workers_find_package

K = 20
#: vectors that the tree is fitted on, at most
SAMPLE = 100_000
BRANCH = 8
#: sample vectors of a leaf, at most
LEAF = 64
ROUNDS = 8
#: sample queries, and the recall that they must reach
CALIBRATION = 256
TARGET_RECALL = 0.94
#: part of the radius that counts in a node's bound
REACH = 0.5
#: vectors, and queries, that one task compares: neighbouring leaves are dealt together,
#: and a group of leaves with more vectors or queries of its own to several tasks
TASK_ITEMS = 1 << 13
TASK_QUERIES = 1 << 16
#: pairs of vectors that are multiplied at once
PAIRS = 1 << 14


class Tree:
    """Nodes in arrays: centroid, radius, first child and number of children;
    a node without children is a leaf, numbered by ``leaf``."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.centroids, self.radii, self.children, self.leaf, self.sizes = [], [], [], [], []
        self.leaves = 0
        random = np.random.default_rng(seed)
        self._add(vectors)
        todo = [(0, vectors)]
        while todo:
            node, rows = todo.pop()
            parts = self._split(rows, random) if len(rows) > LEAF else []
            if len(parts) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            first = len(self.centroids)
            self.children[node] = (first, first + len(parts))
            for part in parts:
                self._add(part)
            todo += [(first + i, part) for i, part in enumerate(parts)]
        self.centroids, self.radii = np.array(self.centroids), np.array(self.radii)

    def _add(self, rows: np.ndarray) -> None:
        centre = rows.mean(axis=0)
        self.centroids.append(centre)
        self.radii.append(math.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
        self.children.append(None)
        self.leaf.append(-1)
        self.sizes.append(len(rows))

    @staticmethod
    def _split(rows: np.ndarray, random) -> list[np.ndarray]:
        centres = rows[random.choice(len(rows), BRANCH, replace=False)]
        for _ in range(ROUNDS):
            nearest = ((centres ** 2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)
            used = np.unique(nearest)
            centres = np.array([rows[nearest == c].mean(axis=0) for c in used])
        nearest = ((centres ** 2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)
        return [rows[nearest == c] for c in np.unique(nearest)]

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centroid, level by level."""
        at = np.zeros(len(vectors), np.int64)
        moving = np.arange(len(vectors))
        while len(moving):
            for node in np.unique(at[moving]).tolist():
                here = moving[at[moving] == node]
                if self.children[node] is not None:
                    a, b = self.children[node]
                    c = self.centroids[a:b]
                    at[here] = a + ((c ** 2).sum(axis=1) - 2 * vectors[here] @ c.T).argmin(axis=1)
            moving = moving[[self.children[n] is not None for n in at[moving].tolist()]]
        return np.array(self.leaf)[at] if len(at) else at

    def visit(self, query: np.ndarray):
        """(leaf, sample vectors in it), best bin first."""
        length = float(np.linalg.norm(query)) * REACH
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.children[node] is None:
                yield self.leaf[node], self.sizes[node]
                continue
            a, b = self.children[node]
            bound = self.centroids[a:b] @ query + self.radii[a:b] * length
            for child, value in zip(range(a, b), bound.tolist(), strict=True):
                heapq.heappush(queue, (-value, child))

    def leaves_for(self, query: np.ndarray, visits: int, k: int) -> list[int]:
        """At least ``visits`` leaves, and as many more as it takes to see twice
        ``k`` sample vectors."""
        out, seen = [], 0
        for leaf, size in self.visit(query):
            if len(out) >= visits and seen >= 2 * k:
                break
            out.append(leaf)
            seen += size
        return out


def held_out(vectors: np.ndarray) -> np.ndarray:
    """Which vectors of the sample are calibration queries, and not in the tree's fit."""
    mark = np.zeros(len(vectors), bool)
    if len(vectors) > 1:
        mark[:: max(2, len(vectors) // CALIBRATION)] = True
    return mark


def calibrate(tree: Tree, vectors: np.ndarray, queries: np.ndarray, k: int, target: float = TARGET_RECALL) -> int:
    """The number of leaves whose visit gives the target recall to ``queries`` (marks of
    vectors that the tree was not fitted on): the ranks at which the leaves of their
    true neighbours among the other vectors are visited are counted."""
    filed = tree.file(vectors)
    ranks = []
    for i in np.flatnonzero(queries).tolist():
        score = vectors @ vectors[i]
        score[i] = -np.inf
        best = filed[np.argsort(-score, kind="stable")[:min(k, len(vectors) - 1)]]
        place = {leaf: j for j, (leaf, _) in enumerate(tree.visit(vectors[i]))}
        ranks += [place[x] for x in best.tolist()]
    ranks = np.sort(ranks)
    return int(ranks[min(len(ranks) - 1, math.ceil(target * len(ranks)) - 1)]) + 1 if len(ranks) else 1


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, and a vector of doubles
    that is not zero, with finite components. Repeated rows count once."""
    v = F.col(column).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(finite & F.exists("v", lambda x: x != 0)).distinct())


def splits(filed: DataFrame, probes: DataFrame) -> DataFrame:
    """(grp, parts, qparts): how many tasks share the vectors of each group of leaves, and
    how many share its queries, by its own counts of both. A row for each group that has
    vectors: no more than the tree has leaves, which the sample bounds."""
    queries = probes.groupBy("grp").agg(F.count("*").alias("queries"))
    return (filed.groupBy("grp").agg(F.count("*").alias("items")).join(queries, "grp", "left")
            .select("grp", F.ceil(F.col("items") / TASK_ITEMS).alias("parts"),
                    F.greatest(F.lit(1), F.ceil(F.coalesce("queries", F.lit(0)) / TASK_QUERIES)).alias("qparts")))


def deal(filed: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with (part, qpart) of their group's tasks. Vectors are repeated only where
    the queries of their own group need several tasks, queries only where its vectors do."""
    counted = F.broadcast(splits(filed, probes))  # at most as many rows as the tree has leaves

    def share(column: str, of: str):
        return F.pmod(F.xxhash64(column), F.col(of))

    def every(of: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    filed = filed.join(counted, "grp").withColumn("part", share("item", "parts")).withColumn("qpart", every("qparts"))
    probes = probes.join(counted, "grp").withColumn("part", every("parts")).withColumn("qpart", share("q", "qparts"))
    return filed.drop("parts", "qparts"), probes.drop("parts", "qparts")


def neighbours(vectors: DataFrame, is_query, k: int = K, column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every query row
    (condition ``is_query`` on vec_id), ties to the smaller vec_id.

    Vectors of another length than most of the sample's take no part. Without
    usable vectors there are no rows."""
    spark = vectors.sparkSession
    workers_find_package(spark)
    rows = materialize(usable(vectors, column), "vectors")
    # equal vectors are one item, named by the smallest of their ids
    by_item = Window.partitionBy("v").orderBy("vec_id")
    items = (rows.withColumn("n", F.row_number().over(by_item)).where(F.col("n") <= k + 1)
             .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    items = materialize(items.select(F.col("ids")[0].alias("item"), "v", "ids"), "items")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = items.select("v", F.xxhash64("item").alias("h")).orderBy("h").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return empty
    sizes = np.array([len(x) for x in sample.column("v").to_pylist()])
    width = int(np.bincount(sizes).argmax())
    sample = np.array([x for x in sample.column("v").to_pylist() if len(x) == width])
    asked_of_tree = held_out(sample)
    tree = Tree(sample[~asked_of_tree])
    visits = calibrate(tree, sample, asked_of_tree, k)
    items = items.where(F.size("v") == width)
    rows = rows.where(F.size("v") == width)
    asked = rows.where(is_query(F.col("vec_id"))).join(items.select(F.col("v").alias("w"), "item"), F.col("v") == F.col("w"))
    asked = materialize(asked.select("vec_id", "item"), "asked")
    asking = materialize(items.join(asked.select("item").distinct(), "item", "left_semi").select(F.col("item").alias("q"), "v"), "queries")
    n = items.count()
    groups = min(tree.leaves, math.ceil(n / TASK_ITEMS))

    def file(batches):
        for batch in batches:
            leaf = tree.file(_matrix(batch.column("v")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64()), pa.array(leaf * groups // tree.leaves, pa.int64())],
                                             [*batch.schema.names, "leaf", "grp"])

    least = F.col("ids")[0].alias("least")
    filed = materialize(items.select("item", "v", least).mapInArrow(file, "item long, v array<double>, least long, leaf long, grp long"), "filed")

    def probe(batches):
        """A row for each group of leaves that a query visits, with these leaves."""
        for batch in batches:
            of, group, leaves = [], [], []
            for i, q in enumerate(_matrix(batch.column("v"))):
                by_group: dict[int, list[int]] = {}
                for leaf in tree.leaves_for(q, visits, k + 1):
                    by_group.setdefault(leaf * groups // tree.leaves, []).append(leaf)
                of += [i] * len(by_group)
                group += by_group
                leaves += by_group.values()
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(of) for c in batch.columns), pa.array(leaves, pa.list_(pa.int64())), pa.array(group, pa.int64())],
                                             [*batch.schema.names, "leaves", "grp"])

    # dealt anew to a fixed number of tasks, so that the walks of the queries are spread
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    probes = materialize(asking.repartition(tasks, "q").mapInArrow(probe, "q long, v array<double>, leaves array<long>, grp long"), "probes")
    filed, probes = deal(filed, probes)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        """The nearest items of each query among the leaves that it visits, ties to the smaller vec_id."""
        schema = pa.schema([("q", pa.int64()), ("item", pa.int64()), ("least", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        queries, own = _matrix(left.column("v")), _matrix(right.column("v"))
        q, item, leaf = left.column("q").to_numpy(), right.column("item").to_numpy(), right.column("leaf").to_numpy()
        first = right.column("least").to_numpy()
        # what the products below may differ by from sums in another order
        slack = 4 * own.shape[1] * np.finfo(np.float64).eps * math.sqrt((own ** 2).sum(axis=1).max())
        members = {x: np.flatnonzero(leaf == x) for x in np.unique(leaf).tolist()}
        visited = left.column("leaves").to_pylist()
        out = []
        step = max(1, (1 << 21) // len(own))
        for i in range(0, len(queries), step):
            some = queries[i:i + step]
            visitors: dict[int, list[int]] = {}
            for row, leaves in enumerate(visited[i:i + step]):
                for x in leaves:
                    if x in members:
                        visitors.setdefault(x, []).append(row)
            score = np.full((len(some), len(own)), -np.inf)
            for x, row in visitors.items():
                score[np.ix_(row, members[x])] = some[row] @ own[members[x]].T
            bound = np.partition(score, -k - 1, axis=1)[:, -k - 1] if len(own) > k + 1 else np.full(len(some), -np.inf)
            bound = bound - slack * np.sqrt((some ** 2).sum(axis=1))
            row, best = np.nonzero((score >= bound[:, None]) & (score > -np.inf))
            # in one order of additions, so that equal vectors score equally
            exact = np.concatenate([np.zeros(0), *((some[row[j:j + PAIRS]] * own[best[j:j + PAIRS]]).sum(axis=1) for j in range(0, len(row), PAIRS))])
            order = np.lexsort((first[best], -exact, row))
            row, best, exact = row[order], best[order], exact[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) <= k
            best = best[kept]
            out.append(pa.table([q[i:i + step][row[kept]], item[best], first[best], exact[kept]], schema=schema))
        return pa.concat_tables(out)

    keys = ["grp", "part", "qpart"]
    found = (probes.groupBy(*keys).cogroup(filed.groupBy(*keys))
             .applyInArrow(compare, "q long, item long, least long, score double"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "least")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("q", "item", "score")
    listed = found.join(items.select("item", "ids"), "item").select("q", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = (listed.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
              .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")))
    listed = materialize(listed, "neighbours")
    answers = asked.join(listed, asked.item == listed.q).select(
        F.col("vec_id").alias("query_id"), F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)).alias("i", "x"))
    return answers.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
