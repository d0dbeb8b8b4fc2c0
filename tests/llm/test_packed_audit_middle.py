"""Token files, filter audit and fill-in-the-middle against plain versions, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from plain import sha
from tokenizers import Tokenizer

from ledgerlark.llm import filteraudit, fillmiddle, tokenfiles
from ledgerlark.llm.queries import END_ID, QUERIES, WORD_VOCABULARY
from ledgerlark.session import run_dir

PATH = public_tokenizers.path(WORD_VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
CLASHING = ["part", "order", "row", "id", "failed", "good", "toxic", "first", "d1", "n", "form", "frames", "marked", "start", "segment"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["Wörter", "and", "It's", "x9,", "END.", "don't", "q...", "é", "안녕.", "a_b"]) + rng.choice(["", "", "\n", "\t", " z"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    rng = random.Random(11)
    found = [(i, prose(rng, rng.randrange(1, 300)), rng.choice(["en", "de", None, ""])) for i in range(90)]
    common = prose(rng, 250)
    found += [(200 + i, common, rng.choice(["en", "fr"])) for i in range(40)]  # copies
    found += [(300, None, "en"), (301, "", "en"), (302, None, None), (303, " \t\n ", "en"), (304, "word", "de"), (305, "ONE TWO", "de")]
    found += [(400, "x<P>y", "en"), (401, "<", "en"), (402, "P>", "en"), (403, "\U0001f600é<|endoftext|>\x00 \x1f\x85", "en"), (404, "H̱a. ẖ éx. ΣΑΣ. İ 12a3.", "en")]
    found += [(None, common, "en"), (None, "no id", "en"), (None, "no id", "en"), (-7, common, "en")]
    found += [(500, common, "en"), (500, common, "en"), (501, "other text", "en"), (501, "text two", "en"), (90, found[3][1], "de"), (90, found[3][1], "de")]
    found += [(600, "A" * 5000, "en"), (601, prose(rng, 4000), "en"), (602, "a b " * 3000, "en"), (603, "ab" * 3000 + " " + "é" * 900, "en")]
    rng.shuffle(found)
    return found


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in CLASHING:
        table = table.selectExpr("*", f"'x' AS `{name}`")
    return table.repartition(5)


def same(found, expected):
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


# token files


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("high", [1, 2, 300, 49_408, 1 << 32])
def test_segments_give_their_ids_back(n, high):
    rng = np.random.default_rng(n + high)
    ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    if n > 255 and high == 300:
        ids[rng.integers(0, n, 9)] = (1 << 32) - 1  # exceptions
    for block, percentiles in ((256, tokenfiles.PERCENTILES), (64, (50,)), (8, (90,))):
        data = tokenfiles.pack(ids, block, percentiles)
        assert tokenfiles.unpack(data).tolist() == ids.tolist()
        for a, b in rng.integers(0, n + 1, (8, 2)).tolist():
            assert tokenfiles.unpack(data, a, b).tolist() == ids[a:b].tolist()


def test_few_large_ids_cost_little():
    ids = np.arange(25_600, dtype=np.uint32) % 16
    plain = len(tokenfiles.pack(ids))
    ids[::300] = 1 << 30
    assert len(tokenfiles.pack(ids)) < plain + 100 * 6 and plain < 25_600 * 0.6


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, END_ID]


def test_codec_equals_the_library(rows):
    texts = [t or "" for _, t, _ in rows]
    for cache in (tokenfiles.CACHE, 20):
        codec = tokenfiles.Codec(PATH)
        old, tokenfiles.CACHE = tokenfiles.CACHE, cache
        for size in (tokenfiles.PIECE, 50):
            for text in texts:
                found = b"".join(codec.encode(p) for p in tokenfiles.pieces(text.encode(), size))
                assert np.frombuffer(found, "<u4").tolist() == ids_of(text)[:-1], text[:80]
        tokenfiles.CACHE = old


def test_crc_of_joined_stretches():
    data = random.Random(2).randbytes(3_000_000)
    for cut in (0, 1, 1_500_000, len(data)):
        assert tokenfiles.join_crc(zlib.crc32(data[:cut]), zlib.crc32(data[cut:]), len(data) - cut) == zlib.crc32(data)


@pytest.mark.parametrize("size", [64, 1000, tokenfiles.SEGMENT])
def test_token_files(spark, docs, rows, size):
    folder = run_dir(spark, "test-tokens")
    tokenfiles.write_tokens(docs, folder, PATH, END_ID, size)
    found = tokenfiles.token_checks(spark, folder).collect()
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], [(d, len(i := ids_of(t)), zlib.crc32(np.array(i, "<u4").tobytes())) for d, t, _ in rows])
    at = 0
    for r in sorted(found, key=lambda r: r.start):  # without gaps, in id order
        assert r.start == at
        at += r.n_tokens
    names = [-(10**9) if r.doc_id is None else r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert names == sorted(names)
    index = tokenfiles.document_index(spark, folder)
    same([(r.doc_id, r.start, r.n_tokens) for r in index.collect()], [(r.doc_id, r.start, r.n_tokens) for r in found])
    wanted = spark.createDataFrame([(601,), (304,), (90,), (-7,), (12345,)], "doc_id long")
    pieces = {}
    for r in sorted(tokenfiles.read_tokens(spark, folder, wanted, size).collect(), key=lambda r: (r.start, r.piece)):
        pieces.setdefault((r.doc_id, r.start), []).extend(r.ids)
    same([(d, i) for (d, _), i in pieces.items()], [(d, ids_of(t)) for d, t, _ in rows if d in (601, 304, 90, -7)])


def test_token_files_of_no_rows(spark, docs):
    folder = run_dir(spark, "test-tokens")
    tokenfiles.write_tokens(docs.where("false"), folder, PATH, END_ID)
    assert tokenfiles.token_checks(spark, folder).count() == 0


def test_token_query_over_the_whole_table(spark, folder):
    texts = sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    expected, at = [], 0
    for doc, text in texts:
        ids = ids_of(text)
        expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    same([tuple(r) for r in QUERIES["op11_packed_token_files"](spark, folder).collect()], expected)


# filter audit


def failures(text, smaller):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return {
        "A": len(words) < 200, "B": 100 * len({*words}) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search("[#$%&*|]", text)), "E": smaller,
    }


def audit(rows, labels):
    order = lambda i: float("inf") if i is None else i
    first = {}
    for doc, text, _ in rows:
        first[text or ""] = min(first.get(text or "", float("inf")), order(doc))
    marks = {}
    for doc, quality, toxic in labels:
        if doc is not None:
            q, t = marks.get(doc, (False, False))
            marks[doc] = (q or quality == 1, t or toxic == 1)
    judged = [(lang or "", failures(text or "", first[text or ""] < order(doc)), *marks.get(doc, (False, False))) for doc, text, lang in rows]
    out = []
    for part in {p for p, *_ in judged}:
        found, shares = [], dict.fromkeys("ABCDE", 0)
        for sequence in permutations("ABCDE"):
            left = [(f, g, t) for p, f, g, t in judged if p == part]
            gone = []
            for step, letter in enumerate(sequence, 1):
                lost = [x for x in left if x[0][letter]]
                left = [x for x in left if not x[0][letter]]
                alone = sum(x[0][letter] and sum(x[0].values()) == 1 for p, *x in judged if p == part)
                found.append((part, "".join(sequence), step, len(left), len(lost), sum(x[0][letter] for x in gone), alone, sum(x[1] for x in lost), sum(x[2] for x in lost), letter))
                gone += lost
                shares[letter] += len(lost)
        out += [(*r[:-1], shares[r[-1]]) for r in found]
    return out


def test_filter_audit(spark, docs, rows):
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 80)] + [(200, 1, 1), (210, None, 1), (5, 1, 1), (5, 0, 0), (None, 1, 1), (500, 1, None), (9999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS part", "2 AS good", "3 AS id")
    same([tuple(r) for r in filteraudit.filter_audit(docs, table).collect()], audit(rows, labels))
    same([tuple(r) for r in filteraudit.filter_audit(docs, table.where("false")).collect()], audit(rows, []))
    assert filteraudit.filter_audit(docs.where("false"), table).count() == 0


def test_positional_counts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 26, 27, 1000):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert filteraudit._positional(words).tolist() == [sum(int(w) >> k & 1 for w in words) for k in range(32)]


def test_survival_words():
    words = filteraudit.survival_words()
    assert int(words[0]) == (1 << 32) - 1 and int(words[31]) == 1 and all((int(words[f]) >> s & 1) == (f & s == 0) for f in range(32) for s in range(32))


# fill in the middle


def middle(doc, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, len(units))))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return (doc, len(units), "plain", None, None, text)
    if h4 % 100 < 20:
        return (doc, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("frame", [1, 7, 100, fillmiddle.FRAME])
def test_fill_in_middle(docs, rows, frame):
    some = docs if frame > 1 else docs.where("length(text) < 3000 OR text IS NULL")
    own = rows if frame > 1 else [r for r in rows if len(r[1] or "") < 3000]
    out = fillmiddle.transform(fillmiddle.store(some, frame), frame)
    expected = [middle(d, t) for d, t, _ in own]
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}
    same([tuple(r) for r in fillmiddle.text(out).collect()], expected)
    restored = fillmiddle.restore(out).select("doc_id", "text").collect()
    same([tuple(r) for r in restored], [(d, t or "") for d, t, _ in own])
    found = fillmiddle.digests(out).select("doc_id", "form", "output_sha256", "restored_sha256").collect()
    same([tuple(r) for r in found], [(m[0], m[2], sha(m[5]), sha(t or "")) for m, (_, t, _) in zip(expected, own, strict=True)])
    assert fillmiddle.digests(fillmiddle.transform(fillmiddle.store(docs.where("false")))).count() == 0


def test_only_the_frames_of_the_cuts_are_opened():
    text = b"ab, " * 50_000
    stored = fillmiddle.Stored(fillmiddle.frames(fillmiddle._stretches(text, 1000)))
    opened, read = [], stored.frame
    stored.frame = lambda k: opened.append(k) or read(k)
    assert stored.place(75_001) == (100_002, 100_002) and len(opened) <= 2
    assert stored.place(stored.total("units")) == (len(text), len(text)) and len(opened) <= 2
    assert b"".join(stored.read(1500, 2500)) == text[1500:2500] and len(opened) <= 4


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_fill_in_middle"])
def test_query_equals_sql_on_awkward_rows(spark, docs, rows, name, tmp_path):
    """The registered SQL says the same of rows without null ids."""
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(0, 80)], "doc_id long, quality int, toxic int")
    docs.where("doc_id IS NOT NULL AND text NOT LIKE '%\\0%'").select("doc_id", "text", "lang").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    from ledgerlark.llm.queries import ORACLE

    connection = duckdb.connect()
    for table in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    found = QUERIES[name](spark, str(tmp_path))
    columns = ", ".join(f'"{c}"' for c in found.columns)
    same([tuple(r) for r in found.collect()], connection.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall())
