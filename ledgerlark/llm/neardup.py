"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

`signatures` hashes each text's set of word shingles once. The hash range is cut into `BINS` bins, each bin keeps its
smallest hash, and an empty bin takes the value of the first non-empty one on a fixed random walk of its own. Bands
of `ROWS` bins are the bucket keys. Documents with equal sets are one class from then on, known by its smallest id.

`links` turns buckets into edges without pairing up all their members. First come stars: a bucket's centres are the
member with most bucket mates, in a group of near copies usually their original, those with the smallest and largest id
and the first by hash; the others are their rays. Pairs are confirmed on full sets: first every class with the best of
its centres, then those edges that still lie across components. `rest` then takes the buckets that still hold several
components, in blocks of bounded size, and settles every pair of theirs that lies across components: by set sizes, by
a lower bound on the difference from parity bitmaps, or on full sets. So no pair that shares a bucket is given up. A
pair of similarity 0.85 shares no bucket with probability below 1e-8.

Texts without words have an empty set and link with nothing. Rows with equal ids are one node. A null id takes no
part: its component is null and it is kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.hashing import mix, numbers, sequence_hashes, word_hashes
from ledgerlark.llm.tables import stored

SHINGLE = 3
PERCENT = 85  # linked if 100 * intersection >= PERCENT * union
BANDS = 40
ROWS = 6
BINS = BANDS * ROWS
PARITY = 1024  # bits of a parity bitmap
BLOCK = 1024  # classes of one block of a bucket
BLOCK_SHINGLES = 1 << 20  # and their shingles, on average


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted different hashes of the word runs; a shorter text is one run, a text without words has none."""
    words = word_hashes((text or "").encode("utf-8", "replace").lower())
    n = min(shingle, len(words))
    return np.unique(sequence_hashes(words, n, seed=n)) if n else words


def one_permutation(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Densified signatures of non-empty sorted sets, one row for each."""
    values = np.zeros((len(sets), bins), dtype=np.uint64)
    filled = np.zeros((len(sets), bins), dtype=bool)
    for k, hashes in enumerate(sets):
        place = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.intp)  # rises with the hash
        first = np.flatnonzero(np.diff(place, prepend=-1))
        values[k, place[first]] = hashes[first]
        filled[k, place[first]] = True
    row, column = np.nonzero(~filled)
    step = 0
    while len(row):
        walk = (mix(np.arange(bins, dtype=np.uint64) + np.uint64(1 + step * bins)) % np.uint64(bins)).astype(np.intp)
        source = walk[column]
        found = filled[row, source]
        values[row[found], column[found]] = values[row[found], source[found]]
        row, column, step = row[~found], column[~found], step + 1
    return values


def band_keys(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band and signature."""
    bands = values.reshape(len(values), -1, rows)
    factors = numbers(5, rows) | np.uint64(1)
    return mix((mix(bands) * factors).sum(axis=2, dtype=np.uint64) + numbers(9, bands.shape[1]))


def _sign(shingle: int, bands: int, rows: int):
    content = numbers(13, 2) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                sets = [shingle_set(t.as_py(), shingle) for t in some.column("text")]
                full = [k for k, s in enumerate(sets) if len(s)]
                keys: list[bytes | None] = [None] * len(sets)
                if full:
                    for k, row in zip(full, band_keys(one_permutation([sets[k] for k in full], bands * rows), rows), strict=True):
                        keys[k] = row.tobytes()
                # two sums over the set, in all 128 bits that tell sets apart
                marks = [[int(mix(s * f).sum(dtype=np.uint64).view(np.int64)) for f in content] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("t"), pa.array([len(s) for s in sets], pa.int64()), *[pa.array([m[i] for m in marks], pa.int64()) for i in (0, 1)], pa.array(keys, pa.binary())],
                    names=["doc_id", "t", "n", "c1", "c2", "keys"],
                )

    return run


def signatures(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`(doc_id, t, n, c1, c2, keys)`: hash of the text, set size, content marks and bucket keys of every text; narrow."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    return texts.mapInArrow(_sign(shingle, bands, rows), "doc_id bigint, t bigint, n bigint, c1 bigint, c2 bigint, keys binary")


def _explode_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            some = batch.slice(at, 4096)
            keys = [np.frombuffer(k, dtype=np.int64) for k in some.column("keys").to_pylist()]
            width = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), *[pa.array(np.repeat(some.column(c).to_numpy(), width)) for c in ("rep", "n")]],
                names=["key", "rep", "n"],
            )


def shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`(rep, hashes)`, one row for each class in `wanted` (rep, t), from the text `t` of its smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                sets = [shingle_set(t.as_py(), shingle).tobytes() for t in some.column("text")]
                yield pa.RecordBatch.from_arrays([some.column("rep"), pa.array(sets, pa.binary())], names=["rep", "hashes"])

    texts = docs.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("t"), "text").join(wanted.select("rep", "t"), ["rep", "t"])
    return texts.dropDuplicates(["rep", "t"]).select("rep", "text").mapInArrow(run, "rep bigint, hashes binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The ends `(x, y)` of the pairs `(a, b, x, y)` whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(linked, pa.bool_())) for c in ("x", "y")], names=["a", "b"])

    left = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("x", "y", "left", "right").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """`(node, root)`: the smallest node reachable over the edges `(a, b)`; only nodes with an edge.

    Every round a node takes the smallest root among its neighbours and then its root's root, so paths halve.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    total = None
    while True:
        weight = labels.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if weight == total:
            return labels
        total = weight
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("root", "near").alias("root"))
        roots = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = stored(lower.join(roots, "root").select("node", F.least("root", "next").alias("root")))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """`labels` after its roots are joined by `edges` between them; a node without a label is its own root."""
    if edges.isEmpty():
        return labels
    lowest = components(edges).select(F.col("node").alias("root"), F.col("root").alias("lowest"))
    known = labels.join(lowest, "root", "left").select("node", F.coalesce("lowest", "root").alias("root"))
    new = lowest.select(F.col("root").alias("node"), F.col("lowest").alias("root")).join(labels, "node", "left_anti")
    return stored(known.unionByName(new))


def _similar_sizes(percent: int):
    return 100 * F.least("n", "m") >= percent * F.greatest("n", "m")


def _parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for hashes in batch.column("hashes"):
            at = (mix(np.frombuffer(hashes.as_py(), dtype=np.uint64)) % np.uint64(PARITY)).astype(np.intp)
            maps.append(np.packbits((np.bincount(at, minlength=PARITY) & 1).astype(np.uint8)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(maps, pa.binary())], names=["rep", "parity"])


GROUP = ["key", "i", "j"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups of rows sorted by `GROUP`, each whole."""
    left: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        names = np.stack([batch.column(c).to_numpy() for c in GROUP])
        starts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
        edges = [0, *starts.tolist(), batch.num_rows]
        if left and last != tuple(names[:, 0]):
            yield pa.concat_tables(left)
            left = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a:
                yield pa.concat_tables(left)
                left = []
            left.append(rows.slice(a, b - a))
        last = tuple(names[:, -1])
    if left:
        yield pa.concat_tables(left)


def _open_pairs(group: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """`(row, other rows)` of a group that may be alike: across components, and across blocks where it has two.

    The parities of two sets differ in no more bits than elements are in one of the sets only.
    """
    n, root, own = (group.column(c).to_numpy() for c in ("n", "root", "own"))
    words = np.frombuffer(b"".join(group.column("parity").to_pylist()), dtype=np.uint64).reshape(len(n), -1)
    two = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    for k in range(len(n) - 1):
        others = np.arange(k + 1, len(n))
        open_ = root[others] != root[k]
        if two:
            open_ &= own[others] != own[k]
        open_ &= 100 * np.minimum(n[others], n[k]) >= percent * np.maximum(n[others], n[k])
        others = others[open_]
        if len(others):
            apart = np.bitwise_count(words[others] ^ words[k]).sum(axis=1, dtype=np.int64)
            # 100 * both >= percent * (n + m - both) with 2 * both = n + m - apart
            others = others[(100 + percent) * apart <= (100 - percent) * (n[others] + n[k])]
        if len(others):
            yield k, others


def _sift(percent: int):
    """The rows of a group that are in an open pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            wanted = np.zeros(group.num_rows, dtype=bool)
            for k, others in _open_pairs(group, percent):
                wanted[k] = True
                wanted[others] = True
            if wanted.any():
                yield from group.filter(pa.array(wanted)).combine_chunks().to_batches()

    return run


def _settle(percent: int):
    """Links between roots that join all rows of a group that its open pairs do: a forest, not all pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            roots = group.column("root").to_numpy()
            _, part = np.unique(roots, return_inverse=True)
            sets = [np.frombuffer(v, dtype=np.uint64) for v in group.column("hashes").to_pylist()]
            found = []
            for k, others in _open_pairs(group, percent):
                for other in others:
                    if part[k] != part[other]:
                        x, y = sets[k], sets[other]
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        if 100 * both >= percent * (len(x) + len(y) - both):
                            part[part == part[other]] = part[k]
                            found.append(sorted((int(roots[k]), int(roots[other]))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[e] for f in found], pa.int64()) for e in (0, 1)], names=["a", "b"])

    return run


def rest(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """Links `(a, b)` between roots that join all components with a link between members `(key, rep, n)` of one bucket;
    None if every bucket lies in one component.

    Large buckets are cut into blocks by hash, and all pairs of blocks compared. Bitmaps go to every bucket, full sets
    only to those where a pair is still open.
    """
    roots = labels.select(F.col("node").alias("rep"), "root")
    known = stored(members.select("key", "rep", "n").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep")))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    mixed = known.groupBy("key").agg(blocks, F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key", "blocks")
    rows = known.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "n", "root")

    def grouped(some: DataFrame) -> DataFrame:
        return some.repartition(*GROUP).sortWithinPartitions(*GROUP)

    parities = sets.mapInArrow(_parity, "rep bigint, parity binary")
    shape = "key bigint, i int, j int, own int, rep bigint, n bigint, root bigint, parity binary"
    near = rows.join(parities, "rep").select(*GROUP, "own", "rep", "n", "root", "parity")
    near = stored(grouped(near).mapInArrow(_sift(percent), shape))
    if near.isEmpty():
        return None
    full = near.join(sets, "rep").select(*GROUP, "own", "rep", "n", "root", "parity", "hashes")
    return stored(grouped(full).mapInArrow(_settle(percent), "a bigint, b bigint").distinct())


def links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """`(node, root)` of the classes `(rep, n, c1, keys)` that have a link."""
    rows = classes.where(F.col("keys").isNotNull()).select("keys", "rep", "n").mapInArrow(_explode_keys, "key bigint, rep bigint, n bigint")
    busy = rows.groupBy("key").agg(F.count(F.lit(1)).alias("mates"), F.min("rep").alias("low"), F.max("rep").alias("high"))
    members = stored(rows.join(busy.where("low < high").select("key", "mates"), "key"))  # buckets of several classes
    degrees = members.groupBy("rep").agg(F.sum("mates").alias("degree"))
    sets = stored(shingle_sets(docs, degrees.join(classes.select("rep", "t"), "rep"), shingle))
    members = members.select("key", "rep", "n").join(degrees, "rep")
    row, rep = F.struct(F.col("rep").alias("other"), F.col("n").alias("m"), F.col("degree").alias("rank")), F.col("rep")
    orders = [F.struct("degree", -rep), rep, -rep, F.xxhash64(rep)]
    centres = members.groupBy("key").agg(F.array_distinct(F.array(*[F.max_by(row, o) for o in orders])).alias("centres"))
    stars = members.join(centres, "key").select("rep", "n", F.explode("centres").alias("c")).select("rep", "n", "c.*")
    a, b = F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")
    pairs = stored(stars.where((rep != F.col("other")) & _similar_sizes(percent)).select(a, b, "rep", "other", "rank").distinct())
    best = pairs.groupBy("rep").agg(F.max_by("other", F.struct("rank", -F.col("other"))).alias("other")).select(a, b).distinct()
    ends = [F.col("a").alias("x"), F.col("b").alias("y")]
    labels = components(stored(confirm(best.select("a", "b", *ends), sets, percent)))
    across = pairs.select("a", "b").distinct().join(best, ["a", "b"], "left_anti")
    for end, name in zip("ab", "xy", strict=True):
        root = labels.select(F.col("node").alias(end), F.col("root").alias(name))
        across = across.join(root, end, "left").withColumn(name, F.coalesce(name, end))
    labels = merged(labels, stored(confirm(across.where("x <> y"), sets, percent)))
    last = rest(members, labels, sets, percent)
    return labels if last is None else merged(labels, last)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)` for every row of `docs`."""
    signed = stored(signatures(docs, shingle, bands, rows))
    classes = stored(
        signed.where(F.col("n") > 0)
        .groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"), F.min_by("t", "doc_id").alias("t"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        .where(F.col("rep").isNotNull())
    )
    labels = links(docs, classes, percent, shingle)
    roots = classes.join(labels, F.col("rep") == F.col("node"), "left").select("c1", "c2", F.coalesce("root", "rep").alias("component"))
    # rows of one id that fall into several components join them
    placed = signed.select("doc_id", "n", "c1", "c2").join(roots, ["c1", "c2"], "left").withColumn("component", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
    placed = stored(placed.select("doc_id", F.col("n").alias("n_shingles"), "component"))
    spread = placed.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    if not spread.isEmpty():
        joined = placed.join(spread.select("doc_id", "a"), "doc_id").select("a", F.col("component").alias("b")).where("a < b")
        merged = components(joined).select(F.col("node").alias("component"), F.col("root").alias("lowest"))
        placed = placed.join(merged, "component", "left").withColumn("component", F.coalesce("lowest", "component"))
    return placed.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))
