"""Operators for text data against plain versions, on small tables with awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from plain import audit, contamination, line_dedup, near_duplicates, sha, substring_dedup, top_k

from ledgerlark.llm import bpe, decontaminate, licenses, linededup, merkle, mtree, neardup, quality, substringdedup, toxicity
from ledgerlark.llm.hashing import PIECE, sequence_hashes, word_hashes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# names that operators use inside
CLASHING = ["row", "key", "g", "n", "rep", "score", "class", "line", "chunk", "digest", "kept", "a", "b"]


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}é"[: rng.randrange(2, 6)] + rng.choice(["", "", ".", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(60)]
    passage = prose(rng, 60)
    found = [(10 + i, t) for i, t in enumerate(texts)]
    found += [(200 + i, texts[3]) for i in range(40)]  # copies
    base = prose(rng, 150).split(" ")
    for i in range(40):  # near copies
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(99)}"
        found.append((300 + i, " ".join(copy)))
    found += [(400 + i, prose(rng, 30) + " " + passage + " " + prose(rng, 20)) for i in range(12)]
    found += [(500, "the " * 300), (501, "a b\n" * 30), (502, "a b\n" * 30)]  # repetition
    found += [(600, None), (601, ""), (602, " \t\n "), (603, "word"), (604, "Word"), (605, "two words"), (None, texts[5]), (None, passage)]
    found += [(700, texts[7]), (700, texts[7]), (701, prose(rng, 50)), (701, texts[8]), (702, texts[8])]  # repeated rows and ids
    found += [(800, "y" * 3000 + " " + prose(rng, 3000)), (801, " " + passage.upper() + "\U0001f600 ok\x00end\x1f x"), (-5, passage)]
    rng.shuffle(found)
    return found


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for name in CLASHING:
        table = table.selectExpr("*", f"'x' AS {name}")
    return table.repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def same(found, expected):
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_word_hashes_follow_words_only():
    text = "ab cd\tab\x0b" + "x" * (3 * PIECE) + " ab"
    h = word_hashes(text.encode())
    assert len(h) == 5 and h[0] == h[2] == h[4] and len({*h.tolist()}) == 3
    parts = [word_hashes(w.encode())[0] for w in text.split()]
    assert h.tolist() == [int(p) for p in parts]
    assert len(word_hashes(b" \n ")) == 0 and len(sequence_hashes(h, 6)) == 0
    assert len({int(x) for x in word_hashes(b" ".join(f"{a}{b}".encode() for a in "abcdefgh" for b in "abcdefgh"))}) == 64


def thue_morse(n: int) -> tuple[str, str]:
    """Two different words that agree in every polynomial modulo a power of two."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_different_words_have_different_hashes(spark):
    one, other = thue_morse(1024)
    tail = " ".join(f"w{k}" for k in range(12))
    assert word_hashes(one.encode())[0] != word_hashes(other.encode())[0]
    texts = [(1, f"{one} {tail}"), (2, f"{other} {tail}"), (3, f"x y {one}"), (4, f"x y {other}")]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    same([tuple(r) for r in substringdedup.substring_dedup(table).collect()], substring_dedup(texts))
    same([tuple(r) for r in neardup.near_duplicates(table).collect()], near_duplicates(texts))


@pytest.mark.parametrize("size", [1000, PIECE, PIECE + PIECE // 2, 3 * PIECE])
def test_equal_words_have_equal_hashes_wherever_they_start(spark, size):
    word = "x" * size
    before = " ".join(["y"] * (9 * PIECE // 20))
    assert word_hashes(word.encode())[0] == word_hashes(f"{before} {word}".encode())[-1]
    tail = " ".join(f"w{k}" for k in range(12))
    texts = [(1, f"{word} {tail}"), (2, f"{before} {word} {tail}"), (3, f"{word} {tail}")]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    same([tuple(r) for r in substringdedup.substring_dedup(table).collect()], substring_dedup(texts))
    assert [r.kept for r in neardup.near_duplicates(table).orderBy("doc_id").collect()] == [True, True, False]


def test_contamination(spark, docs, rows):
    texts = dict(rows)
    items = [(1, texts[-5]), (2, "Two WORDS"), (3, None), (4, "..."), (5, texts[500]), (6, texts[-5]), (None, "word"), (8, " ".join(texts[801].split()[3:20])), (9, "a b a b a b a b a b a b a b a b")]
    items = spark.createDataFrame(items, "item_id long, text string")
    plain = contamination(rows, [tuple(r) for r in items.collect()])
    for broadcast in (100_000, 0):
        found = decontaminate.contamination(docs, items, broadcast=broadcast).drop("row")
        same([tuple(r) for r in found.collect()], plain)
    assert any(p[5] for p in plain) and any(0 < p[2] < p[1] for p in plain)


def test_contamination_without_windows(spark, docs, empty, rows):
    items = spark.createDataFrame([(1, None)], "item_id long, text string")
    assert {(r.n_hit, r.contaminated) for r in decontaminate.contamination(docs, items).collect()} == {(0, False)}
    assert decontaminate.contamination(empty, items).count() == 0


def test_substring_dedup(docs, empty, rows):
    for group, bucket in ((1 << 22, 1 << 24), (2_000, 3_000)):
        found = substringdedup.substring_dedup(docs, group, bucket)
        same([tuple(r) for r in found.collect()], substring_dedup(rows))
    assert substringdedup.substring_dedup(empty).count() == 0


def test_difference_cover_aligns_any_two_places():
    for i in range(7):
        for j in range(7):
            assert any((i + d) % 7 in substringdedup.COVER and (j + d) % 7 in substringdedup.COVER for d in range(7))


def test_near_duplicates(docs, empty, rows):
    found = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    same(found, near_duplicates(rows))
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_through_chains(spark):
    """Neighbours of a chain are linked, its ends are not alike."""
    words = [f"v{i}" for i in range(400)]
    chain = [(i, " ".join(words[6 * i : 6 * i + 120])) for i in range(30)]
    random.Random(1).shuffle(chain)
    found = neardup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string"))
    same([tuple(r) for r in found.collect()], near_duplicates(chain))


@pytest.mark.parametrize("block", [neardup.BLOCK, 16])
def test_near_duplicates_without_their_original(spark, monkeypatch, block):
    """Independently edited copies, about as alike as the limit; no copy is near to most others."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(1)
    copies = []
    for i in range(150):
        copy = [f"v{k}" for k in range(200)]
        for at in rng.sample(range(200), 4):
            copy[at] = f"x{rng.randrange(10**6)}"
        copies.append((i, " ".join(copy)))
    expected = near_duplicates(copies)
    assert sum(r[3] for r in expected) < 150
    same([tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(copies, "doc_id long, text string")).collect()], expected)


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    other = np.unique(np.concatenate([base[:240], rng.integers(0, 1 << 63, 60).astype(np.uint64)]))
    a, b = neardup.one_permutation([base, other], 4096)
    truth = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
    assert abs((a == b).mean() - truth) < 0.08
    small = neardup.one_permutation([base[:1], base[:1]])
    assert (small[0] == base[0]).all() and (small[0] == small[1]).all()


def test_line_dedup(docs, empty, rows):
    found = linededup.line_dedup(docs).select("doc_id", "text", "__n_lines", "__n_removed")
    same([tuple(r) for r in found.collect()], line_dedup(rows))
    assert linededup.line_dedup(docs, run=3).columns[:2] == ["doc_id", "text"]
    same([tuple(r) for r in linededup.line_dedup(docs, run=3).select("doc_id", "text", "__n_lines", "__n_removed").collect()], line_dedup(rows, 3))
    assert linededup.line_dedup(empty).count() == 0


def test_line_dedup_of_single_long_lines(spark):
    """A line of 13 words is a run by itself, one of 12 is not; columns may have the names used inside."""
    long, short = " ".join(f"w{k}" for k in range(13)), " ".join(f"v{k}" for k in range(12))
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, long), (4, f"x\n{short}"), (5, f"y\n{short}"), (6, f"{long}\n\n {long}\n{long}")]
    rows += [(7, long.replace(" ", "\t  ")), (8, "\t" + long.replace(" ", "\t  ")), (9, long.replace(" ", "\t  ")), (None, f"{short}\n{long}"), (10, "z" * 100_000 + " " + long), (11, "z" * 100_000 + " " + long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("__gone", "__row", "__id", "__n_lines", "first", "size", "print", "place"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    found = linededup.line_dedup(docs.repartition(3))
    assert "__gone" in found.columns and found.columns.count("__n_lines") == 1
    same([tuple(r) for r in found.select("doc_id", "text", "__n_lines", "__n_removed").collect()], line_dedup(rows))
    kept = {r.doc_id: r.text for r in found.collect()}
    assert kept[2] == "c\nd" and kept[3] == "" and kept[5] == f"y\n{short}" and kept[6] == f"\n {long}"
    same([tuple(r) for r in linededup.line_dedup(docs, 3, 5).select("doc_id", "text", "__n_lines", "__n_removed").collect()], line_dedup(rows, 3, 5))


def test_token_digests(docs, empty, rows):
    codec = bpe.codec(PATH, PATTERN)
    ranks = {codec.bytes_of[k]: k for k in codec.bytes_of}
    library = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha((text or "").encode())))
    for size, overlap in ((bpe.SIZE, bpe.OVERLAP), (64, 32), (40, 8)):  # small overlaps fail on long pieces
        same([tuple(r) for r in bpe.token_digests(docs, PATH, PATTERN, size, overlap).collect()], expected)
    assert bpe.token_digests(empty, PATH, PATTERN).count() == 0


def test_parts_decode_to_the_text(docs, rows):
    parts = bpe.decode(bpe.encode(docs.where("doc_id >= 800"), PATH, PATTERN, 256, 64), PATH, PATTERN).orderBy("doc_id", "chunk").collect()
    for doc, text in rows:
        if (doc or 0) >= 800:
            assert b"".join(p.data for p in parts if p.doc_id == doc) == text.encode()


def test_top_k(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=6).round(2).tolist()) for i in range(150)]
    vectors += [(200 + i, [0.5] * 6) for i in range(60)]  # one common vector
    vectors += [(300, None), (301, [1.0, None, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [0.25, -1.0]), (None, [1.0] * 6)]
    vectors += [vectors[0], vectors[40], (260, [0.125] * 6), (260, [0.5] * 6)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 AS class", "2 AS cell", "3 AS ids", "4 AS v")
    own = [v for v in vectors if v[0] != 260] + [(260, [0.5] * 6)]
    table260 = table.where("vec_id <> 260 OR vec_id IS NULL").unionByName(table.where("vec_id = 260").limit(0))
    extra = spark.createDataFrame([(260, [0.5] * 6)], "vec_id long, embedding array<float>").selectExpr("*", "1 AS class", "2 AS cell", "3 AS ids", "4 AS v")
    for pivots, shard, asking in ((16, 16_384, 16_384), (4, 16, 2), (1, 50, 1)):
        found = mtree.top_k(table260.unionByName(extra), k=7, every=20, pivots=pivots, shard=shard, asking=asking)
        same([tuple(r) for r in found.collect()], top_k(own, 7, 20))
    assert {r.query_id for r in mtree.top_k(table, k=7, every=20).collect()} >= {260}  # an id with two vectors
    assert mtree.top_k(table.where("false")).count() == 0
    with pytest.raises(ValueError, match="after scaling"):
        mtree.top_k(spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>"))


def test_tree_saves_distances():
    """On vectors in clusters most inner products are never computed, and the result stays exact."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-3000, 3000, size=(40, 8))
    points = np.concatenate([c + rng.integers(-20, 20, size=(400, 8)) for c in centres]).astype(np.float64)
    top = float((points**2).sum(axis=1).max())
    tree = mtree.Tree(points, np.arange(len(points)), top)
    for q in points[::1600]:
        before = tree.computed
        scores, rows = tree.search(q, 10)
        order = np.lexsort((np.arange(len(points)), -(points @ q)))[:10]
        assert rows.tolist() == order.tolist() and scores.tolist() == (points @ q)[order].tolist()
        assert tree.computed - before < len(points) / 2


def test_merkle_audit(spark):
    rng = random.Random(6)
    pages = [(i * 3, f"http://h{i % 5}/", "<p>é" * rng.randrange(9)) for i in range(-20, 120)]
    pages += [(33, "http://again/", "x"), (33, "http://again/", "x"), (None, "http://no/", "id"), (None, None, None), (7, None, ""), (8, "", None), (10**12, "u", "v")]
    replica = [p for p in pages if p[0] not in (9, 30)] + [(1000, "new", "page")]
    replica = [(i, u, "other" if i in (-6, 33, 60) else h) if not (i is None and u is None) else (None, None, "") for i, u, h in replica]
    replica = [(7, "", "") if p[0] == 7 else p for p in replica]
    schema = "page_id long, url string, html string"
    a, b = (spark.createDataFrame(rng.sample(p, len(p)), schema).selectExpr("*", "1 AS id", "2 AS digest") for p in (pages, replica))
    found = [(r.page_id, r.state, r.offset, r.length) for r in merkle.audit(a, b).collect()]
    same(found, audit(pages, replica))
    assert len(found) == 8
    assert merkle.audit(a, a.repartition(3)).count() == 0
    plan = merkle.audit(a, b)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2, "leaves of both sides are reduced before they are joined"
    assert merkle.audit(a.where("false"), a.where("false")).count() == 0
    same([(r.page_id, r.state) for r in merkle.audit(a.where("false"), b.where("page_id = 7")).collect()], [(7, "extra")])


def junk(rng, kind):
    if kind == 0:
        return " ".join(f"{w}***" for w in prose(rng, 80).split())
    if kind == 1:
        return prose(rng, 80).upper().replace(" ", "!! ")
    return " ".join([rng.choice(["foo", "bar"])] * 90)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(7)
    texts, labels = [], []
    for i in range(600):
        bad, rude = i % 5 == 0, i % 4 == 0
        words = (junk(rng, i % 3) if bad else prose(rng, rng.randrange(20, 150), 4000)).split(" ")
        for _ in range(3 * rude):
            words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "nitwit", "dimwits", "numskull"]))
        texts.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(rude)))
    labels += [(None, 1, 1), (3, None, None), (4, labels[4][1], labels[4][2]), (9999, 1, 0)]
    texts += [(1000, None), (1001, ""), (1002, "w1 " * 5), (None, "w2 w3"), (1, texts[1][1])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS y", "3 AS predicted")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("label,run,divisor,rest", [("quality", quality.quality_scores, 5, 0), ("toxic", toxicity.toxicity_scores, 4, 2)])
def test_classifiers_on_held_out_rows(spark, judged, label, run, divisor, rest):
    docs, labels = judged
    found = run(spark, docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % divisor == rest if r.doc_id is not None else None)
    truth = {r.doc_id: r[label] for r in labels.collect() if r[label] is not None}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_classifiers_without_labels(spark, judged, empty):
    docs, labels = judged
    none = labels.where("false")
    assert {(r.score, r.predicted) for r in quality.quality_scores(spark, docs, none).collect()} == {(0.5, 1)}
    assert {(r.score, r.predicted) for r in toxicity.toxicity_scores(spark, docs, none).collect()} == {(0.0, 0)}
    assert quality.quality_scores(spark, empty, labels).count() == toxicity.toxicity_scores(spark, empty, labels).count() == 0


def test_isotonic_levels_never_fall():
    x, y = quality.isotonic(np.arange(5.0), np.array([0, 1, 0, 1, 1.0]), np.ones(5))
    assert x.tolist() == [0, 1.5, 3.5] and y.tolist() == [0, 0.5, 1]


def edits(a: str, b: str) -> int:
    row = [*range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_misspelled_words():
    terms = ["nitwit", "blockhead", "fool", "numskulls", "dolt*"]
    automaton, rng = toxicity.Automaton(terms), random.Random(8)
    words = [*(t.rstrip("*") for t in terms)]
    for t in words * 60:
        w = list(t)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randrange(2)] = rng.choice(["", "z", "é", "o"])
        words = [*words, "".join(w)]
    words = [w for w in words if w.isalnum()]
    starts, ends, found, costs, n = automaton.find(" ".join(words))
    text, hits = " ".join(words), {}
    for s, e, t, c in zip(starts, ends, found, costs, strict=True):
        hits[text[s:e]] = (automaton.terms[t], int(c))
    assert n == len(words)
    for w in {*words}:
        near = [(edits(w, t), t) for t in terms[:4] if edits(w, t) <= toxicity.edits_allowed(t, False)]
        if w.startswith("dolt"):
            assert hits[w] == ("dolt*", 0)
        elif near:
            assert hits[w][1] == min(near)[0], w
        else:
            assert w not in hits, (w, hits[w])


def test_quotation_is_told_from_abuse():
    text = 'he said "you nitwit" loudly, and later on in the long evening, you are a nitwit and everybody there knew it'
    first, second = text.index("nitwit"), text.rindex("nitwit")
    assert toxicity.is_quoted(text, first, first + 6) and not toxicity.is_quoted(text, second, second + 6)


def test_license_scan(spark, docs, empty):
    notices = [("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("MIT", "Released under the MIT License."), ("CC-BY-NC", "Licensed under CC BY-NC 4.0."), ("GPL", "This work is licensed under the GNU General Public License, version 3.")]
    rng = random.Random(9)
    texts = [(k, prose(rng, 40).replace("\n", " ") + "\n" + notices[k % 4][1] + "\n" + prose(rng, 10)) for k in range(40)]
    table = spark.createDataFrame(texts, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    found = licenses.license_scan(table).collect()
    assert len(found) == table.count()
    for r in found:
        known = r.doc_id is not None and 0 <= r.doc_id < 40 and r.n_paragraphs > 1 and r.families
        if known:
            assert r.families == notices[r.doc_id % 4][0]
    assert sum(bool(r.families) for r in found) == 40
    assert {(r.n_paragraphs, r.families) for r in found if r.doc_id in (600, 601, 602)} == {(0, "")}
    assert licenses.license_scan(empty).count() == 0


def test_license_in_a_long_line(spark):
    """A notice is found wherever it stands in a line of thousands of words, and another one beside it."""
    rng = random.Random(10)
    words = prose(rng, 3000).replace("\n", " ").split()
    rows = []
    for k, at in enumerate((0, 17, 63, 500, 2999)):
        line = [*words[:at], "Licensed under the Apache License, Version 2.0.", *words[at:]]
        rows.append((k, "first line\n" + " ".join(line) + "\nlast line"))
    rows.append((10, " ".join(words)))
    rows.append((11, " ".join([*words[:700], "Released under the MIT License.", *words[700:], "Licensed under the Apache License, Version 2.0."])))
    plain = [(100 + k, prose(rng, 60)) for k in range(60)]
    table = spark.createDataFrame(rows + plain, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.license_scan(table).collect()}
    assert [found[k].families for k in range(5)] == ["Apache-2.0"] * 5 and found[0].n_paragraphs == 3
    assert found[10].families == "" and found[11].families == "Apache-2.0,MIT"
    model = licenses.fit(table)
    for text in (rows[3][1], rows[10 - 4][1], plain[0][1]):  # every window by itself
        lines, spans, p = model.probabilities(text)
        _, _, words, pairs = licenses.paragraph_features(text)
        for (start, end), q in zip(spans, p, strict=True):
            if start >= 0:  # words, and pairs that begin in the window
                n = end - start + (pairs[start:end] >= 0).sum()
                alone = model.constants + (model.weights[words[start:end]] + model.weights[pairs[start:end]]).sum(axis=0) / np.sqrt(n)
                assert end - start <= max(licenses.WINDOWS) and np.allclose(licenses.softmax(alone[None] / model.temperature)[0], q, atol=1e-3)


def test_lexicon_of_several_automata():
    rng = random.Random(11)
    terms = sorted({"".join(rng.choice("abcde") for _ in range(rng.randrange(3, 11))) for _ in range(60)} | {"abcab*", "eddc*"})
    text = " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(2, 12))) for _ in range(4000)) + " abcabzzz eddcx"
    one, several = toxicity.Automaton(terms).find(text), toxicity.Lexicon(terms, 7).find(text)
    assert one[4] == several[4] and len(one[0]) > 50
    assert one[0].tolist() == several[0].tolist() and one[1].tolist() == several[1].tolist()
    stems = np.isin(one[2], [k for k, t in enumerate(terms) if t.endswith("*")])
    assert one[3][~stems].tolist() == several[3][~stems].tolist()


def test_terms_are_not_capped():
    holders = {f"term{k:04d}": [3 * k, 3 * k + 1, 3 * k + 2] for k in range(400)}
    assert sorted(toxicity.choose_terms(holders)) == sorted(holders)
    holders = {"blockhead*": [1, 2, 3, 4], "blockheads": [1, 2, 3], "blockheaded": [2, 3, 4], "block*": [1, 2, 3], "rare": [9]}
    assert toxicity.choose_terms(holders) == ["blockhead*", "blockheaded", "blockheads"]
