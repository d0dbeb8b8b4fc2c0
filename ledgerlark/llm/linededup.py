"""Line dedup by winnowing over line hashes, in DataFrame functions only.

Lines are split at newlines; those of white space only are kept and not compared. A run is `RUN` consecutive other
lines, or one line of `WORDS` words or more. A line goes if a run that covers it also starts at an earlier place: a
smaller id, or the same document higher up. Runs are judged on the input, so every stretch of `RUN` or more lines that
was there before is deleted whole, and so is every long line.

Of the hashes of each run's lines a document keeps the smallest; a kept line is its fingerprint, and two equal runs
keep the same one. A long line is its own fingerprint. Fingerprints are counted first. Runs around a fingerprint that occurs at several places are then
extended to all their lines and compared by 128 bits; the first place of each is found by partial aggregation, so a
line that half of the documents share costs one row per task there. Adjoining repeated runs add up to the longest
match in both directions.

Null texts have no lines; null ids come after all others. Rows of one id and text are the same place and treated
alike. Other columns are passed on, whatever their names; `__n_lines` and `__n_removed` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.decontaminate import let

RUN = 2  # lines
WORDS = 13  # of a line that is a run by itself
SPACE, LETTER = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    """`(at, line)` of the lines that are compared."""
    numbered = F.transform(F.split(text, "\n"), lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(r"\S"))


def _long(lines: Column, words: int) -> Column:
    """`(first, size, print, kept, k1, k2)` of every line of `words` words or more."""
    pattern = f"^{SPACE}*+(?:{LETTER}++{SPACE}++){{{words - 1}}}{LETTER}"
    runs = F.transform(
        lines,
        lambda x, j: F.when(
            x["line"].rlike(pattern),
            F.struct(
                j.alias("first"), F.lit(1).alias("size"), F.xxhash64(F.lit("line"), x["line"]).alias("print"), F.lit(True).alias("kept"),
                F.xxhash64(F.lit("one"), x["line"]).alias("k1"), F.xxhash64(F.lit("long"), x["line"]).alias("k2"),
            ),
        ),
    )
    return F.filter(runs, lambda r: r.isNotNull())


def _runs(lines: Column, run: int) -> Column:
    """`(first, size, print, kept, k1, k2)` of every run: number of its first line, lines, its fingerprint, whether that
    is a new one, and the hashes of all its lines."""
    starts = F.sequence(F.lit(0), F.size(lines) - run)

    def shape(texts: Column) -> Column:
        hashes = F.transform(texts, lambda t: F.xxhash64(t))

        def each(h: Column) -> Column:
            prints = F.transform(starts, lambda j: F.array_min(F.slice(h, j + 1, run)))
            return let(
                prints,
                lambda p: F.transform(
                    starts,
                    lambda j: F.struct(
                        j.alias("first"),
                        F.lit(run).alias("size"),
                        F.get(p, j).alias("print"),
                        # a fingerprint stays the same until another line is smaller or it leaves the run
                        ((j == 0) | (F.get(p, j) != F.get(p, j - 1)) | (F.get(h, j - 1) == F.get(p, j - 1))).alias("kept"),
                        F.xxhash64(F.slice(texts, j + 1, run)).alias("k1"),
                        F.xxhash64(F.lit("run"), F.slice(texts, j + 1, run)).alias("k2"),
                    ),
                ),
            )

        return let(hashes, each)

    return F.when(F.size(lines) >= run, let(F.transform(lines, lambda x: x["line"]), shape))


def repeated_lines(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """`(doc_id, row, gone)`: numbers among the compared lines, for texts that lose some."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), _lines(F.col("text")).alias("lines"))
    found = let(F.col("lines"), lambda x: F.flatten(F.array_compact(F.array(_runs(x, run), _long(x, words)))))
    runs = rows.select("doc_id", "row", F.explode(found).alias("r")).select("doc_id", "row", "r.*")
    busy = runs.where("kept").groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print")
    near = runs.join(busy, "print", "left_semi").select(
        "k1", "k2", F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("first")).alias("place"), "row", "size"
    )
    earliest = near.groupBy("k1", "k2").agg(F.min("place").alias("earliest"), F.max("place").alias("latest")).where("earliest < latest")
    later = near.join(earliest.select("k1", "k2", "earliest"), ["k1", "k2"]).where("earliest < place")
    return later.select("row", "size", "place.doc_id", "place.first").distinct().groupBy("doc_id", "row").agg(
        F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("first"), F.col("first") + F.col("size") - 1)))).alias("gone")
    )


def line_dedup(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """All rows and columns with the deleted lines taken out of `text`, and `__n_lines`, `__n_removed` (compared lines)."""
    gone = repeated_lines(docs, run, words).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("gone").alias("__gone"))
    here, lost = F.xxhash64(docs["doc_id"], docs["text"]), gone["__gone"]
    joined = docs.join(gone, (here == gone["__row"]) & docs["doc_id"].eqNullSafe(gone["__id"]), "left")

    def left(lines: Column) -> Column:
        taken = F.transform(lost, lambda j: F.get(lines, j)["at"])
        return let(taken, lambda t: F.array_join(F.filter(F.split(docs["text"], "\n"), lambda line, at: ~F.array_contains(t, at)), "\n"))

    text = F.when(lost.isNull(), docs["text"]).otherwise(let(_lines(docs["text"]), left))
    kept = [text.alias("text") if c == "text" else docs[c] for c in docs.columns if c not in ("__n_lines", "__n_removed")]
    removed = F.when(lost.isNull(), 0).otherwise(F.size(lost))
    n_lines = F.when(docs["text"].isNull(), 0).otherwise(F.size(_lines(docs["text"])))
    return joined.select(*kept, n_lines.cast("long").alias("__n_lines"), removed.cast("long").alias("__n_removed"))


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, a, x, row_number() OVER (PARTITION BY doc_id ORDER BY a) - 1 AS j
           FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS a, unnest(p) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))
           WHERE regexp_matches(x, '\S')),
r AS (SELECT doc_id, j, x, lead(x) OVER (PARTITION BY doc_id ORDER BY j) AS y FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, j) AS n FROM r WHERE y IS NOT NULL),
o AS (SELECT doc_id, j, row_number() OVER (PARTITION BY x ORDER BY doc_id, j) AS n FROM l WHERE regexp_matches(x, '([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){12}[^\x20\x09-\x0D]')),
g AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, j FROM f WHERE n > 1 UNION ALL SELECT doc_id, j + 1 FROM f WHERE n > 1 UNION ALL SELECT doc_id, j FROM o WHERE n > 1)),
k AS (SELECT doc_id, a FROM l JOIN g USING (doc_id, j)),
p AS (SELECT doc_id, unnest(range(1, len(q) + 1)) AS a, unnest(q) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS q FROM documents)),
t AS (SELECT p.doc_id, string_agg(x, chr(10) ORDER BY p.a) AS kept FROM p LEFT JOIN k ON p.doc_id = k.doc_id AND p.a = k.a WHERE k.a IS NULL GROUP BY p.doc_id),
c AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id), m AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(m.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN t USING (doc_id)
"""
