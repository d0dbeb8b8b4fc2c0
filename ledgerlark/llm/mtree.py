"""Exact top-k by inner product with best-first search of M-trees.

Vectors become whole numbers, `floor(64 * x)`. One more coordinate, `sqrt(M^2 - |x|^2)` for candidates (M the largest
norm) and 0 for queries, turns the largest inner product into the smallest Euclidean distance, a metric.

Equal vectors are one class with its `k + 1` smallest ids; more of them can never be among the best k. `PIVOTS`
classes, the first by hash, are the routing objects at the top; each class belongs to the nearest. A cell of more than
`SHARD` classes is split by hash, and where a cell is asked by more than `ASKING` queries, these are dealt over several
copies of its shards; so no task holds more than a shard and a block of queries. Each shard is an M-tree of pages: routing entries with covering radius and distance
to their parent, leaf entries with distance to theirs. Equal query vectors are searched once. A query first searches
the cell it lies in; its k-th best score there closes whole cells, and inside a shard pages and single entries whose
stored distances show that they cannot do better, without computing them. Ties go on to the smaller id, so bounds that
are just met are followed. The result is exact whatever the bounds save.

Vectors that are null or hold a null or non-finite component take no part, nor do rows without an id. Shorter vectors
are continued with zeros. Repeated rows count once; an id with several vectors is several candidates, and as a query
has one list for each of them. A component beyond 2^20 after scaling raises an error. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.hashing import mix
from ledgerlark.llm.tables import cut

SCALE = 64
EVERY = 20
K = 20
PIVOTS = 16
SHARD = 16_384
ASKING = 16_384  # queries that one task answers from a shard, on average
PAGE = 512  # entries of a leaf page, at most
FANOUT = 64  # entries of a routing page, at most
LARGEST = 1 << 20
SLACK = 1e-6  # of distances, for rounding


class Page:
    """Entries of one node: members of `Tree.points` for a leaf, else routing objects with a child each."""

    def __init__(self, members: np.ndarray, to_parent: np.ndarray, radii: np.ndarray | None = None, children: list[Page] | None = None):
        self.members, self.to_parent, self.radii, self.children = members, to_parent, radii, children


class Tree:
    """M-tree over rows of whole numbers with one added coordinate."""

    def __init__(self, points: np.ndarray, smallest_ids: np.ndarray, largest_norm2: float):
        self.points, self.ids = points, smallest_ids
        self.norm2 = np.einsum("ij,ij->i", points, points, dtype=np.float64)
        self.top = largest_norm2
        self.extra = np.sqrt(np.maximum(largest_norm2 - self.norm2, 0))
        self.computed = 0  # inner products with queries
        everything = np.arange(len(points))
        self.root = self._page(everything, None) if len(points) else None

    def _distances(self, members: np.ndarray, router: int) -> np.ndarray:
        inner = (self.points[members] @ self.points[router]).astype(np.float64) + self.extra[members] * self.extra[router]
        square = self.norm2[members] + self.extra[members] ** 2 + self.norm2[router] + self.extra[router] ** 2 - 2 * inner
        return np.sqrt(np.maximum(square, 0))

    def _page(self, members: np.ndarray, parent: int | None) -> Page:
        to_parent = np.zeros(len(members)) if parent is None else self._distances(members, parent)
        if len(members) <= PAGE:
            return Page(members, to_parent)
        n = min(FANOUT, math.ceil(2 * len(members) / PAGE))
        routers = members[np.argsort(mix(members.astype(np.uint64)), kind="stable")[:n]]
        far = np.stack([self._distances(members, r) for r in routers])
        nearest = far.argmin(axis=0)
        if np.bincount(nearest, minlength=n).max() > 0.9 * len(members):  # nothing to tell them apart: even parts
            nearest = np.arange(len(members)) % n
        used = [k for k in range(n) if (nearest == k).any()]
        radii = np.array([far[k, nearest == k].max() for k in used])
        routers = routers[used]
        children = [self._page(members[nearest == k], int(r)) for k, r in zip(used, routers, strict=True)]
        return Page(routers, np.zeros(len(routers)) if parent is None else self._distances(routers, parent), radii, children)

    def search(self, query: np.ndarray, k: int, least: float = -math.inf) -> tuple[np.ndarray, np.ndarray]:
        """Scores and rows of the best `k`, best first, of those with a score of at least `least`."""
        norm2 = float(query.astype(np.float64) @ query)
        reach = lambda score: math.sqrt(max(norm2 + self.top - 2 * score, 0)) + SLACK if score > -math.inf else math.inf
        scores, rows = np.zeros(0), np.zeros(0, dtype=np.intp)
        bound, queue, ticket = reach(least), [(0.0, 0, self.root, None)], 1
        while queue:
            nearest, _, page, from_parent = heapq.heappop(queue)
            if nearest > bound:
                break
            members, keep = page.members, None
            if from_parent is not None and bound < math.inf:
                gap = np.abs(from_parent - page.to_parent) - (0 if page.radii is None else page.radii)
                keep = np.flatnonzero(gap <= bound)
                members = members[keep]
            if not len(members):
                continue
            inner = (self.points[members] @ query).astype(np.float64)
            self.computed += len(members)
            if page.children is None:
                good = inner >= least
                if good.any():
                    scores, rows = np.concatenate([scores, inner[good]]), np.concatenate([rows, members[good]])
                    if len(scores) > k:
                        best = np.lexsort((self.ids[rows], -scores))[:k]
                        scores, rows = scores[best], rows[best]
                        least = max(least, float(scores[-1]))
                        bound = reach(least)
                continue
            distance = np.sqrt(np.maximum(norm2 + self.top - 2 * inner, 0))
            radii = page.radii if keep is None else page.radii[keep]
            for entry, d, low in zip(range(len(members)) if keep is None else keep, distance, distance - radii, strict=True):
                if low <= bound:
                    heapq.heappush(queue, (max(low, nearest), ticket, page.children[entry], d))
                    ticket += 1
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return scores[best], rows[best]


def matrix(column: pa.ChunkedArray | pa.Array, width: int, kind: type) -> np.ndarray:
    """Lists of whole numbers as rows, shorter ones continued with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(-1, width).astype(kind)
    out, at = np.zeros((len(lengths), width), dtype=kind), 0
    for row, n in enumerate(lengths):
        out[row, :n] = values[at : at + n]
        at += n
    return out


def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """`(vec_id, v, class)`: the usable vectors in whole numbers, with a digest that equal ones share."""
    x = F.col(column)
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    scaled = vectors.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(SCALE * c.cast("double"))).alias("v"))
    return scaled.withColumn("class", F.sha2(F.array_join("v", ","), 256))


def _assign(pivots: np.ndarray, top: float):
    """Nearest pivot and distance to it."""
    norms = np.einsum("ij,ij->i", pivots, pivots, dtype=np.float64)
    extra = np.sqrt(np.maximum(top - norms, 0))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"), pivots.shape[1], np.float64)
            own = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))
            distance = np.sqrt(np.maximum(2 * top - 2 * (x @ pivots.T + own[:, None] * extra), 0))
            cell = distance.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(distance[np.arange(len(cell)), cell])], names=[*batch.schema.names, "cell", "distance"]
            )

    return run


def _visits(pivots: np.ndarray, top: float, radii: np.ndarray, parts: np.ndarray, home: bool):
    """A row per query and shard: at home the shards of the query's cell, else those of cells it cannot rule out."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix(batch.column("v"), pivots.shape[1], np.float64)
            square = np.einsum("ij,ij->i", q, q)
            distance = np.sqrt(np.maximum(square[:, None] + top - 2 * (q @ pivots.T), 0))
            if home:
                wanted = np.zeros(distance.shape, dtype=bool)
                wanted[np.arange(len(q)), batch.column("cell").to_numpy()] = True
            else:
                least = batch.column("least").to_numpy(zero_copy_only=False)
                reach = np.sqrt(np.maximum(square + top - 2 * np.where(np.isnan(least), -np.inf, least), 0)) + SLACK
                wanted = distance - radii <= reach[:, None]
                wanted[np.arange(len(q)), batch.column("cell").to_numpy()] = False
            row, cell = np.nonzero(wanted & (parts > 0))
            many = parts[cell]
            part = np.concatenate([np.arange(n) for n in many]) if len(many) else np.zeros(0, dtype=np.int64)
            taken = batch.take(pa.array(np.repeat(row, many)))
            yield pa.RecordBatch.from_arrays(
                [taken.column("class"), taken.column("v"), taken.column("least"), pa.array(np.repeat(cell, many).astype(np.int32)), pa.array(part.astype(np.int32))],
                names=["class", "v", "least", "cell", "part"],
            )

    return run


def _search(width: int, top: float, k: int, kind: type):
    def run(key: tuple, points: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if points.num_rows and queries.num_rows:
            ids = points.column("ids").to_pylist()
            tree = Tree(matrix(points.column("v"), width, kind), np.array([i[0] for i in ids]), top)
            least = queries.column("least").to_numpy()
            for name, q, low in zip(queries.column("class").to_pylist(), matrix(queries.column("v"), width, kind), least, strict=True):
                scores, rows = tree.search(q, k, -math.inf if np.isnan(low) else low)
                found += [(name, int(s), ids[r][0], ids[r]) for s, r in zip(scores, rows, strict=True)]
        kinds = {"class": pa.string(), "score": pa.int64(), "smallest": pa.int64(), "ids": pa.list_(pa.int64())}
        return pa.table({name: pa.array([f[i] for f in found], t) for i, (name, t) in enumerate(kinds.items())})

    return run


FOUND = "class string, score long, smallest long, ids array<long>"


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, pivots: int = PIVOTS, shard: int = SHARD, asking: int = ASKING, column: str = "embedding") -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for ids divisible by `every`, the `k` best other ids."""
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, column)
    result = "query_id long, rank int, vec_id long, score long"
    in_class = Window.partitionBy("class").orderBy("vec_id")
    # rank 1 to k + 1 of each class; Spark drops the rest of a class before the shuffle
    firsts = rows.distinct().withColumn("n", F.row_number().over(in_class)).where(F.col("n") <= k + 1)
    classes = cut(firsts.groupBy("class").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids")))
    square = F.aggregate("v", F.lit(0).cast("double"), lambda a, c: a + c.cast("double") * c)
    size = classes.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(square), F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))).first()
    if not size[0]:
        return spark.createDataFrame([], result)
    width, top, highest = max(size[1], 1), float(size[2] or 0), size[3] or 0
    if highest > LARGEST:
        raise ValueError(f"a component is {highest} after scaling; exact scores need at most {LARGEST}")
    kind = np.float32 if width * float(highest) ** 2 < 1 << 24 else np.float64  # whole sums stay exact in either
    chosen = classes.orderBy(F.xxhash64("class"), "class").limit(pivots).select("v").collect()
    middle = np.array([[*r["v"], *[0] * (width - len(r["v"]))] for r in chosen], dtype=np.float64)
    placed = classes.mapInArrow(_assign(middle, top), classes.withColumn("cell", F.lit(0)).withColumn("distance", F.lit(0.0)).schema)
    placed = cut(placed)
    radii, parts = np.zeros(len(middle)), np.zeros(len(middle), dtype=np.int64)
    for cell in placed.groupBy("cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).collect():  # one row per pivot
        radii[cell["cell"]], parts[cell["cell"]] = cell["radius"] + SLACK, math.ceil(cell["n"] / shard)
    split = F.element_at(F.array(*[F.lit(max(int(p), 1)) for p in parts]), F.col("cell") + 1)
    points = placed.select("cell", F.pmod(F.xxhash64("class", F.lit("part")), split).cast("int").alias("part"), "v", "ids")
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "class").distinct()
    queries = placed.join(asked.select("class").distinct(), "class", "left_semi").select("class", "v", "cell")

    def visit(who: DataFrame, home: bool) -> DataFrame:
        sent = who.mapInArrow(_visits(middle, top, radii, parts, home), "class string, v array<long>, least double, cell int, part int")
        # all shards of a cell get the same queries; one row per pivot
        busy = dict(sent.where("part = 0").groupBy("cell").count().collect())
        many = [max(math.ceil(busy.get(cell, 0) / asking), 1) for cell in range(len(middle))]
        blocks = F.element_at(F.array(*[F.lit(n) for n in many]), F.col("cell") + 1)
        keys = ["cell", "part", "block"]
        copies = points.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        dealt = sent.withColumn("block", F.pmod(F.xxhash64("class", F.lit("block")), blocks).cast("int"))
        return copies.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_search(width, top, k + 1, kind), FOUND)

    best = Window.partitionBy("class").orderBy(F.desc("score"), "smallest")
    at_home = cut(visit(queries.withColumn("least", F.lit(float("nan"))), True).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1))
    bounds = at_home.where(F.col("n") == k + 1).select("class", F.col("score").cast("double").alias("least"))
    elsewhere = visit(queries.join(bounds, "class", "left").withColumn("least", F.coalesce("least", F.lit(float("nan")))), False)
    lists = at_home.drop("n").unionByName(elsewhere).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    each = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    lists = lists.select("class", "score", F.explode("ids").alias("vec_id")).withColumn("n", F.row_number().over(each)).where(F.col("n") <= k + 1).drop("n")
    own = Window.partitionBy("query_id", "class").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(lists, "class").where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


ORACLE_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
