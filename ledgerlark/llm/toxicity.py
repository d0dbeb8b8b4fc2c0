"""Toxicity: Levenshtein automata intersected with a lexicon trie, context windows, and a small logistic model.

The lexicon is learnt: words and word beginnings ("stems") that labelled toxic texts have and clean ones lack, from
a bounded sample (`SAMPLE` labelled documents of either class, near copies reduced to one), chosen greedily until
each toxic text holds `COVER` of them or none is left that `SUPPORT` texts still lack. All terms with support and lift
are considered, and no number of terms is set: the sample bounds it. Words below a chosen stem stay beside it for the
sake of their misspellings. Stems themselves and terms below five letters allow no edits, since too many clean words
are one letter away from them.

`Automaton` determinises the product of the trie with the edit automata of its terms: a state is the set of trie
nodes a misspelled beginning may stand at, with the edits spent. Longer terms allow more edits. All words of a
batch run through the table side by side, one letter per step. A large lexicon is several automata of `TERMS` terms each. A hit inside quotation marks, or near a word of
reporting, counts as quotation and goes into columns of its own. A logistic model over the hit counts gives the
score; its weights follow the true share of either class.

Null and empty texts have no hits and get the score of a text without hits. Without labels of both kinds every
score is 0. Rows with equal ids are scored one by one; a null id has a score and a null `held_out`; other columns
are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.hashing import sequence_hashes, word_hashes
from ledgerlark.llm.tables import cut, labelled, remainder, training_texts

SAMPLE = 3_000  # labelled documents of either class used for fitting, at most
TERMS = 120  # of one automaton
COVER = 3
SUPPORT = 3  # sampled toxic texts that hold a term, at least
LIFT = 20  # times as common in toxic texts as in clean ones, at least
STEMS = range(4, 9)  # lengths of word beginnings
THRESHOLD = 0.3
WINDOW = 40  # characters of context on either side of a hit
PIECE = 1 << 20  # characters worked on at once

# fixed values: marks of quotation and words of reporting
QUOTES = "\"“”„«»‹›"
REPORTING = "said says say quote quoted quotes called calls word words term wrote writes saying sagte schrieb zitiert dit écrit cité dijo escribió citó"

_WORD = re.compile(r"[^\W_]+")


def words_and_stems(text: str | None) -> set[str]:
    """Lower-case words, and beginnings of longer words marked by a trailing `*`."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if k < len(w)}


def edits_allowed(term: str, stem: bool) -> int:
    return 0 if stem or len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Table automaton of all words within the allowed edits of a term, or beginning with a stem."""

    def __init__(self, terms: Iterable[str]):
        self.terms = sorted(set(terms))
        children: list[dict[str, int]] = [{}]
        ends: list[tuple[int, int, bool] | None] = [None]  # term, edits allowed, stem
        budget = [0]  # most edits that any term below allows
        for number, term in enumerate(self.terms):
            stem, letters = term.endswith("*"), term.rstrip("*")
            allowed, node = edits_allowed(letters, stem), 0
            for letter in ["", *letters]:
                if letter:
                    if letter not in children[node]:
                        children[node][letter] = len(children)
                        children.append({})
                        ends.append(None)
                        budget.append(0)
                    node = children[node][letter]
                budget[node] = max(budget[node], allowed)
            if ends[node] is None or stem:
                ends[node] = (number, allowed, stem)
        alphabet = sorted({letter for node in children for letter in node})
        self.letters = {letter: k + 1 for k, letter in enumerate(alphabet)}  # class 0: any other letter

        def closed(costs: dict[int, int]) -> frozenset:
            """With the nodes reached by leaving out letters of a term."""
            todo = sorted(costs.items(), key=lambda x: x[1])
            for node, cost in todo:
                for child in children[node].values():
                    if cost < budget[child] and costs.get(child, 9) > cost + 1:
                        costs[child] = cost + 1
                        todo.append((child, cost + 1))
            return frozenset(costs.items())

        def step(state: frozenset, letter: str | None) -> frozenset:
            costs: dict[int, int] = {}

            def reach(node: int, cost: int) -> None:
                if cost <= budget[node] and cost < costs.get(node, 9):
                    costs[node] = cost

            for node, cost in state:
                reach(node, cost + 1)
                for edge, child in children[node].items():
                    reach(child, cost + (edge != letter))
            return closed(costs)

        start = closed({0: 0})
        states, rows, todo = {frozenset(): 0, start: 1}, {0: [0] * (len(alphabet) + 1)}, [start]
        self.stem_of: dict[int, int] = {}
        accept: dict[int, tuple[int, int]] = {}
        while todo:
            state = todo.pop()
            number = states[state]
            found = [(cost, ends[node][0], ends[node][2]) for node, cost in state if ends[node] and cost <= ends[node][1]]
            stems = [x for x in found if x[2]]
            if found:
                cost, term, _ = min(stems or found)
                accept[number] = (term, cost)
            if stems:  # whatever follows, the word begins with the stem
                rows[number] = [number] * (len(alphabet) + 1)
                self.stem_of[number] = min(stems)[1]
                continue
            row = []
            for letter in (None, *alphabet):
                after = step(state, letter)
                if after not in states:
                    states[after] = len(states)
                    todo.append(after)
                row.append(states[after])
            rows[number] = row
        self.table = np.array([rows[k] for k in range(len(states))], dtype=np.int32)
        self.term = np.full(len(states), -1, dtype=np.int32)
        self.cost = np.zeros(len(states), dtype=np.int8)
        for state, (term, cost) in accept.items():
            self.term[state], self.cost[state] = term, cost
        self.resting = np.zeros(len(states), dtype=bool)
        self.resting[[0, *self.stem_of]] = True
        self._class = np.zeros(1 << 16, dtype=np.int16)
        for letter, number in self.letters.items():
            if ord(letter) < 1 << 16:
                self._class[ord(letter)] = number

    def find(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Start, end, term and edits of each hit of a lower-case text, and its number of words."""
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
        low = np.minimum(points, 0xFFFF).astype(np.intp)
        inside = np.concatenate(([0], _letters()[low], [0])).astype(np.int8)
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        classes = self._class[low]
        state = np.ones(len(starts), dtype=np.int32)
        alive, at = np.arange(len(starts)), starts.copy()
        while len(alive):
            state[alive] = self.table[state[alive], classes[at]]
            at = at + 1
            going = (at < ends[alive]) & ~self.resting[state[alive]]
            alive, at = alive[going], at[going]
        hit = np.flatnonzero(self.term[state] >= 0)
        return starts[hit], ends[hit], self.term[state[hit]], self.cost[state[hit]], len(starts)


_letter_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which of the first 65536 code points are letters or digits (the last entry stands for all beyond)."""
    if not _letter_table:
        _letter_table.append(np.array([*(chr(c).isalnum() for c in range(0xFFFF)), True]))
    return _letter_table[0]


_CUES = re.compile(r"\b(?:" + "|".join(REPORTING.split()) + r")\b")


def is_quoted(text: str, start: int, end: int) -> bool:
    """Quotation marks on both sides within the window, or a word of reporting before the hit."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    marks = sum(before.count(q) for q in QUOTES)
    return (marks % 2 == 1 and any(q in after for q in QUOTES)) or bool(_CUES.search(before))


def pieces(text: str) -> Iterator[str]:
    """Parts of a long text, cut between words."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and text[end].isalnum():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def hit_counts(text: str | None, automaton: Automaton | Lexicon) -> list[float]:
    """Counts of exact and misspelled hits in abuse and in quotation, different terms, hits per word."""
    counts, terms, n = [0.0] * 4, set(), 0
    for part in pieces((text or "").lower()):
        starts, ends, found, costs, words = automaton.find(part)
        n += words
        for start, end, term, cost in zip(starts.tolist(), ends.tolist(), found.tolist(), costs.tolist(), strict=True):
            counts[2 * is_quoted(part, start, end) + (cost > 0)] += 1
            terms.add(term)
    total = sum(counts)
    return [*np.log1p(counts).tolist(), float(np.log1p(len(terms))), float(np.log1p(100 * total / max(n, 1))), float(total > 0)]


COUNTS = 7


class Lexicon:
    """Automata over the terms in alphabetical order, `TERMS` in each, read as one."""

    def __init__(self, terms: Iterable[str], size: int = TERMS):
        self.terms = sorted(set(terms))
        self.parts = [Automaton(self.terms[k : k + size]) for k in range(0, max(len(self.terms), 1), size)]
        self.size = size

    def find(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """As of one automaton: a word that several know counts once, with the fewest edits."""
        found = [part.find(text) for part in self.parts]
        if len(found) == 1:
            return found[0]
        starts, ends, terms, costs = (np.concatenate([f[k] + (number * self.size if k == 2 else 0) for number, f in enumerate(found)]) for k in range(4))
        order = np.lexsort((terms, costs, starts))
        order = order[np.diff(starts[order], prepend=-1) > 0]
        return starts[order], ends[order], terms[order], costs[order], found[0][4]


@dataclass
class ToxicityModel:
    automaton: Lexicon | None
    weights: np.ndarray | None = None

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        if self.automaton is None or self.weights is None:
            return np.zeros(len([*texts]))
        x = np.array([hit_counts(t, self.automaton) for t in texts]).reshape(-1, COUNTS)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def choose_terms(holders: dict[str, list[int]]) -> list[str]:
    """Greedy cover: terms in the order of the toxic texts that still lack `COVER` of them, then the whole words below
    chosen stems that allow edits."""
    need: dict[int, int] = defaultdict(lambda: COVER)
    rank = {t: k for k, t in enumerate(sorted(holders, key=lambda t: (not t.endswith("*"), len(t), t), reverse=True))}

    def gain(term: str) -> int:
        return sum(need[i] > 0 for i in set(holders[term]))

    # of equal gains: a whole word before a stem, then the longer one. Gains only fall, so the top is worked out anew
    queue = [(-gain(t), rank[t], t) for t in holders]
    heapq.heapify(queue)
    stems, shut, chosen = set(), set(), []
    while queue:
        before, place, term = heapq.heappop(queue)
        root = term.rstrip("*")
        if term in shut or any(root[:k] in stems for k in STEMS if k <= len(root)):
            continue
        now = -gain(term)
        if -now < SUPPORT:
            continue
        if now != before:
            heapq.heappush(queue, (now, place, term))
            continue
        chosen.append(term)
        for i in set(holders[term]):
            need[i] -= 1
        if term.endswith("*"):
            stems.add(root)
        shut |= {f"{root[:k]}*" for k in STEMS}
    below = {t for t in holders if not t.endswith("*") and edits_allowed(t, False) and any(t[:k] in stems for k in STEMS if k < len(t))}
    return [*chosen, *sorted(below - set(chosen))]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the constant is not penalised."""
    z = np.hstack([np.ones((len(x), 1)), x])
    penalty = ridge * np.eye(z.shape[1])
    penalty[0, 0] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + penalty @ w
        change = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, slope)
        w -= change / max(1.0, np.abs(change).max() / 4)
        if np.abs(change).max() < 1e-8:
            break
    return w


def _without_copies(rows: DataFrame) -> DataFrame:
    """One of each group of near copies: rows that agree in the smallest hash of their 3-word runs, for three hashes."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for text in batch.column("text"):
                data = (text.as_py() or "").encode("utf-8", "replace")
                runs = [sequence_hashes(word_hashes(data), 3, seed) for seed in (1, 2, 3)]
                marks.append([str(r.min()) if len(r) else str(data) for r in runs])
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([m[k] for m in marks], pa.string()) for k in range(3)]], names=[*batch.schema.names, "a", "b", "c"])

    marked = rows.mapInArrow(smallest, "doc_id bigint, text string, y int, a string, b string, c string")
    # the smallest id of equal marks, so that a rerun keeps the same rows; the sample is bounded
    alike = marked.groupBy("y", "a", "b", "c").agg(F.min_by(F.struct("doc_id", "text"), "doc_id").alias("row"))
    return alike.select("row.doc_id", "row.text", "y")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn label `toxic` from labelled ids whose crc32 remainder modulo 4 is not 2."""
    train = remainder("doc_id", 4) != 2
    shares = dict(labels.where(train & F.col("toxic").isNotNull()).groupBy("toxic").count().collect())  # two rows
    ids = labelled(labels, "toxic", sample, train, per_class=True)
    rows = cut(_without_copies(training_texts(docs, ids)))
    sizes = dict(rows.groupBy("y").count().collect())  # two rows
    if not sizes.get(0) or not sizes.get(1):
        return ToxicityModel(None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y"), strict=True):
                tally[y.as_py()].update(words_and_stems(text.as_py()))
        names = [*tally[1]]  # a term that no toxic text of any task has is of no use
        yield pa.RecordBatch.from_pydict({"term": pa.array([*names, *(t for t in tally[0] if t not in tally[1])], pa.string()), "toxic": pa.array([*(tally[1][t] for t in names), *(0 for t in tally[0] if t not in tally[1])], pa.int64()), "clean": pa.array([*(tally[0][t] for t in names), *(n for t, n in tally[0].items() if t not in tally[1])], pa.int64())})

    rate = (F.col("toxic") / sizes[1]) / ((F.col("clean") + 0.5) / (sizes[0] + 1))
    terms = (
        rows.mapInArrow(count, "term string, toxic bigint, clean bigint")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= SUPPORT) & (rate >= LIFT))
        .collect()  # of the sample only
    )
    wanted = {r["term"] for r in terms}

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(t, d.as_py()) for text, d in zip(batch.column("text"), batch.column("doc_id"), strict=True) for t in words_and_stems(text.as_py()) & wanted]
            yield pa.RecordBatch.from_pydict({"term": pa.array([t for t, _ in found], pa.string()), "doc_id": pa.array([d for _, d in found], pa.int64())})

    holders = defaultdict(list)
    for r in rows.where("y = 1").mapInArrow(hold, "term string, doc_id bigint").toLocalIterator():  # of the sample only
        holders[r["term"]].append(r["doc_id"])
    automaton = Lexicon(choose_terms(holders))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [hit_counts(t.as_py(), automaton) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    known = rows.mapInArrow(counts, "y int, x array<double>").collect()  # 2 * SAMPLE rows at most
    x, y = np.array([r["x"] for r in known]), np.array([float(r["y"]) for r in known])
    weight = np.where(y == 1, max(shares.get(1, 0), 1) / sizes[1], max(shares.get(0, 0), 1) / sizes[0])
    return ToxicityModel(automaton, logistic(x, y, weight * len(y) / weight.sum()))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """`(doc_id, score, predicted)` of every row; narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(t.as_py() for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double, predicted int")


def toxicity_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document with a model learnt from the labelled part."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
