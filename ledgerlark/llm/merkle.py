"""Merkle fixity audit of WARC records: hash trees over ordered ranges, compared from the root down.

A record is a WARC response with the page's address, an id and its HTML. Leaves are the records of one page id, in id
order; a node of level n covers `2^(4 n)` neighbouring ids and hashes the digests of its at most 16 children, with
the number of records and bytes below. Levels are added until all ids are under one node, or two if some
are negative; these are the root. Every level is a `groupBy` whose groups are bounded; the leaf of an id with many records is a sum of
their digests, so a hot id is added up in every task first.

`audit` compares the roots, then at each level joins only children of nodes that differ. Byte offsets come from the
stored sizes of a branch's earlier siblings, so sound branches are never opened. Each differing leaf is reported as
changed, missing (not in the replica) or extra, with its byte range in the original archive.

Null addresses and HTML are told apart from empty ones. Records without an id form one leaf behind all others. Ids may
repeat: equal rows count, their order does not. Two empty archives are equal. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.tables import cut
from ledgerlark.operators.ordered import small_side

BITS = 4  # 16 children


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a page's WARC record."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def leaves(pages: DataFrame) -> DataFrame:
    """`(id, records, bytes, digest)` of every page id; the digest is hexadecimal SHA-256."""
    text = record(F.col("page_id"), F.col("url"), F.col("html"))
    known = F.concat(F.col("url").isNull().cast("string"), F.col("html").isNull().cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("id"), text.alias("r"), known.alias("k")).select(
        "id", F.octet_length("r").cast("long").alias("bytes"), F.sha2(F.concat("k", "r"), 256).alias("digest")
    )
    # 15 hexadecimal digits at a time: sums of them do not overflow before 10^20 records
    parts = [F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = rows.groupBy("id").agg(F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"), F.min("digest").alias("one"), *[F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)])
    many = F.sha2(F.concat_ws(",", "records", *[f"s{i}" for i in range(4)]), 256)
    return sums.select("id", "records", "bytes", F.when(F.col("records") == 1, F.col("one")).otherwise(many).alias("digest"))


def parents(nodes: DataFrame) -> DataFrame:
    """The level above."""
    children = F.array_sort(F.collect_list(F.struct("id", "digest")))  # 16 at most
    text = F.concat_ws(";", F.transform(children, lambda c: F.concat_ws(":", c["id"].cast("string"), c["digest"])))
    return nodes.groupBy(F.shiftright("id", BITS).alias("id")).agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.sha2(text, 256).alias("digest"))


def trees(pages: DataFrame) -> list[DataFrame]:
    """All levels from the leaves up, written once. The last one has three nodes at most: ids from 0 on, negative ids,
    and records without an id."""
    levels = [cut(leaves(pages))]
    while levels[-1].where("id NOT IN (0, -1)").limit(1).count():
        levels.append(cut(parents(levels[-1])))
    return levels


def root(levels: list[DataFrame]) -> tuple:
    """What stands for a whole archive: id, records, bytes and digest of its top nodes."""
    rows = [(str(r["id"]), r["records"], r["bytes"], r["digest"]) for r in levels[-1].collect()]  # three at most
    return tuple(sorted(rows))


def audit(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """`(page_id, state, offset, length, digest, replica_digest)` of every differing leaf.

    `offset` is where the original's records of that id begin in id order (for an extra record: would begin).
    """
    first, second = trees(pages), trees(replica)
    while len(first) < len(second):  # the shorter id range gets the same height
        first.append(cut(parents(first[-1])))
    while len(second) < len(first):
        second.append(cut(parents(second[-1])))

    def compare(level: int, held: DataFrame | None = None) -> DataFrame:
        """Both sides of a level; of `held`, nodes of the level above, only their children."""
        sides = [levels[level] for levels in (first, second)]
        if held is not None:
            near = small_side(held.select("above"))
            sides = [s.join(near, F.shiftright("id", BITS).eqNullSafe(F.col("above")), "left_semi") for s in sides]
        a = sides[0].select(F.col("id").alias("a"), "bytes", "digest")
        b = sides[1].select(F.col("id").alias("b"), F.col("digest").alias("replica_digest"))
        joined = a.join(b, F.col("a").eqNullSafe(F.col("b")) & (F.col("digest").isNotNull()), "full")
        return joined.select(F.when(F.col("digest").isNotNull(), F.col("a")).otherwise(F.col("b")).alias("id"), "bytes", "digest", "replica_digest")

    wrong = ~F.col("digest").eqNullSafe(F.col("replica_digest"))
    top = len(first) - 1
    base = dict.fromkeys([-1, 0, None], 0)
    # three rows at most: negative ids lie before the others, records without an id behind them
    sizes = {r["id"]: r["bytes"] for r in first[top].collect()}
    base[0] = sizes.get(-1, 0)
    base[None] = base[0] + sizes.get(0, 0)
    start = F.when(F.col("id").isNull(), base[None]).when(F.col("id") == 0, base[0]).otherwise(0).cast("long")
    same_root = root(first) == root(second)
    open_nodes = compare(top).withColumn("offset", start).where(F.lit(not same_root) & wrong)
    for level in range(top - 1, -1, -1):
        held = cut(open_nodes.select(F.col("id").alias("above"), F.col("offset").alias("from")))
        children = compare(level, held).withColumn("up", F.shiftright("id", BITS)).join(held, F.col("up").eqNullSafe(F.col("above")))
        # sizes of earlier siblings: a sum over 16 rows at most
        before = F.sum(F.coalesce("bytes", F.lit(0))).over(Window.partitionBy("above").orderBy("id").rowsBetween(Window.unboundedPreceding, -1))
        placed = children.withColumn("offset", F.col("from") + F.coalesce(before, F.lit(0)))
        open_nodes = placed.select("id", "bytes", "digest", "replica_digest", "offset").where(wrong)
    state = F.when(F.col("replica_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return open_nodes.select(F.col("id").alias("page_id"), state.alias("state"), "offset", F.coalesce("bytes", F.lit(0)).cast("long").alias("length"), "digest", "replica_digest")


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with faults by rule: changed HTML, changed addresses and lost records."""
    n = F.col("page_id")
    return pages.where(n.isNull() | (F.pmod(n, F.lit(211)) != 5)).select(
        "page_id",
        F.when(F.pmod(n, F.lit(307)) == 11, F.concat("url", F.lit("#"))).otherwise(F.col("url")).alias("url"),
        F.when(F.pmod(n, F.lit(101)) == 7, F.concat("html", F.lit("?"))).otherwise(F.col("html")).alias("html"),
    )


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, url, html, CASE WHEN page_id % 307 = 11 THEN url || '#' ELSE url END AS url2, CASE WHEN page_id % 101 = 7 THEN html || '?' ELSE html END AS html2 FROM pages),
r AS (SELECT page_id, page_id % 211 = 5 AS lost,
  concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Length: ', strlen(html), chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10)) AS a,
  concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url2, chr(13), chr(10), 'Content-Length: ', strlen(html2), chr(13), chr(10), chr(13), chr(10), html2, chr(13), chr(10), chr(13), chr(10)) AS b FROM p),
o AS (SELECT *, CAST(coalesce(sum(strlen(a)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM r)
SELECT page_id, CASE WHEN lost THEN 'missing' ELSE 'changed' END AS state, "offset", CAST(strlen(a) AS BIGINT) AS "length", sha256('falsefalse' || a) AS digest,
  CASE WHEN NOT lost THEN sha256('falsefalse' || b) END AS replica_digest
FROM o WHERE lost OR a <> b
"""
