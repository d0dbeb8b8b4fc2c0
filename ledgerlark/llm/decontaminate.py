"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts become lower-case words. A window is `WINDOW` consecutive words of a benchmark item, or the whole item if it
has fewer. Of the hashes of all runs of `GRAM` words, a document keeps the smallest of every `WINDOW - GRAM + 1`
neighbours. Each benchmark window has that many runs, so its own smallest one is kept wherever the window occurs: no
occurrence is missed. Kept hashes of documents and windows are joined, every match is extended to the whole window
and compared word by word. Items shorter than a window are looked up by the hash of all their words at every place.

`n_hit` counts words covered by any occurrence. Null texts have no words, null or wordless items no windows. Null item
ids count as the text "null". Rows with equal ids are judged one by one; repeated rows give equal rows; other columns
are ignored. Without any window nothing is hit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.tables import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# all of ASCII that is no part of a word [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
WINDOW = 13
GRAM = 7
BROADCAST = 100_000  # windows of the benchmark up to which they are sent to every executor; beyond, Spark shuffles
SHARE = 20  # contaminated if SHARE * n_hit >= n_words


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once, even if `use` has it inside a function of array items."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Lower-case words; one pass over the characters, which is twice as fast as matching words by a pattern."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def run_hashes(hashes: Column, n: int | Column) -> Column:
    """Hash of every run of `n` items, null if there are fewer."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(F.size(hashes) >= n, F.transform(F.sequence(F.lit(0), F.size(hashes) - n), lambda i: F.xxhash64(F.slice(hashes, i + 1, n))))


def word_hashes(items: Column) -> Column:
    return F.transform(items, lambda w: F.xxhash64(w))


def winnowed(hashes: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """`(len, fp, at)` of the runs kept: the smallest of each `window - gram + 1` neighbours.

    The last three bits of a hash hold its place modulo 8, which tells where in the window the minimum stands.
    """
    width = window - gram + 1  # 8 at most
    marked = lambda runs: F.transform(runs, lambda h, i: F.shiftleft(h, 3).bitwiseOR(i.bitwiseAND(F.lit(7)).cast("long")))
    smallest = lambda v: F.transform(F.sequence(F.lit(0), F.size(v) - width), lambda j: F.array_min(F.slice(v, j + 1, width)))

    def kept(minima: Column) -> Column:
        places = F.transform(minima, lambda m, j: F.struct(m.alias("m"), (j + F.pmod(m.bitwiseAND(F.lit(7)).cast("int") - j, F.lit(8))).alias("at")))
        return F.filter(places, lambda p, j: (j == 0) | (p["m"] != F.get(minima, j - 1)))

    runs = F.when(F.size(hashes) >= window, run_hashes(hashes, gram))
    found = let(runs, lambda r: let(marked(r), lambda v: let(smallest(v), kept)))
    shape = lambda p: F.struct(F.lit(window).alias("len"), F.shiftleft(F.shiftright(p["m"], 3), 3).alias("fp"), p["at"].alias("at"))
    return F.when(F.size(hashes) >= window, F.transform(found, shape))


def every_run(hashes: Column, n: int) -> Column:
    """`(len, fp, at)` of the runs of `n` words at all places."""
    return F.transform(run_hashes(hashes, n), lambda h, i: F.struct(F.lit(n).alias("len"), h.alias("fp"), i.alias("at")))


def benchmark_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """`(key, item_id)` of all windows, and `(len, fp, offset, key)`: where in the window its kept hashes stand.

    The key is the window's words joined by one space, which no word contains.
    """
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id")
    whole = items.select(name, words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    pairs = cut(
        whole.select("item_id", F.explode(let(F.col("w"), lambda w: F.transform(starts, lambda i: F.slice(w, i + 1, window)))).alias("w"))
        .select(F.array_join("w", " ").alias("key"), "item_id", F.size("w").alias("len")).distinct()
    )
    distinct = pairs.select("key", "len").distinct().withColumn("h", word_hashes(F.split("key", " ")))
    runs = distinct.withColumn("r", F.when(F.col("len") < window, F.transform(run_hashes(F.col("h"), F.col("len")), lambda r: r)).otherwise(F.transform(run_hashes(F.col("h"), gram), lambda r: F.shiftleft(r, 3))))
    least = runs.withColumn("fp", F.array_min("r"))
    # a document keeps one of equal minima, so the window is listed under each
    offsets = F.filter(F.sequence(F.lit(0), F.size("r") - 1), lambda i: F.get("r", i) == F.col("fp"))
    return pairs.select("key", "item_id"), cut(least.select("len", "fp", F.explode(offsets).alias("offset"), "key"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, share: int = SHARE, broadcast: int = BROADCAST) -> DataFrame:
    """`(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, row)` of every row of `docs`.

    `row` is `xxhash64(doc_id, text)`, by which rows of equal ids can be told apart.
    """
    pairs, prints = benchmark_windows(items, window, gram)
    short = sorted(r["len"] for r in prints.where(F.col("len") < window).select("len").distinct().collect())  # window - 1 at most
    if prints.limit(broadcast + 1).count() <= broadcast:
        prints = F.broadcast(prints)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))

    def fingerprints(hashes: Column) -> Column:
        # the list of lengths comes from the benchmark and has window - 1 entries at most
        parts = [winnowed(hashes, window, gram), *(every_run(hashes, n) for n in short)]
        none = F.array().cast("array<struct<len:int,fp:bigint,at:int>>")
        return F.concat(*[F.coalesce(p, none) for p in parts])

    kept = rows.select("row", F.explode(let(word_hashes(words(F.col("text"))), fingerprints)).alias("f")).select("row", "f.*")
    matches = (
        kept.join(prints, ["len", "fp"]).select("row", (F.col("at") - F.col("offset")).alias("start"), "len", "key").where("start >= 0")
        .groupBy("row").agg(F.collect_set(F.struct("start", "len", "key")).alias("matches"))
    )
    joined = rows.join(matches, "row", "left")
    real = let(words(F.col("text")), lambda w: F.filter("matches", lambda m: F.array_join(F.slice(w, m["start"] + 1, m["len"]), " ") == m["key"]))
    judged = cut(
        joined.select("row", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), F.when(F.col("matches").isNotNull(), real).alias("real"))
        .select(
            "row", "doc_id", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
            F.coalesce(covered(F.col("real")), F.lit(0)).cast("long").alias("n_hit"),
            F.array_distinct(F.transform("real", lambda m: m["key"])).alias("keys"),
        )
    )
    held = (
        judged.select("row", F.explode("keys").alias("key")).distinct().join(pairs, "key").select("row", "item_id").distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    )
    ids = F.coalesce(F.array_join("ids", ","), F.lit(""))
    return judged.join(held, "row", "left").select(
        "doc_id", "n_words", "n_hit", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "row",
    )


def covered(matches: Column) -> Column:
    """Number of words inside any of the spans."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].cast("long").alias("start"), (m["start"] + m["len"]).cast("long").alias("stop"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(total: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0).cast("long"), span["stop"] - F.greatest(span["start"], total["end"]))
        return F.struct((total["n"] + new).alias("n"), F.greatest(total["end"], span["stop"]).alias("end"))

    return F.aggregate(spans, zero, add, lambda total: total["n"])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s : s + 12], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
