"""Toxicity: Levenshtein automata over a lexicon trie, with context-window scores.

1. Lexicon: words and word stems (prefixes) that stand in far more toxic than other documents of
   a bounded labelled sample, by log-odds and likelihood ratio, at most MAX_TERMS of each; a term
   must stand in MIN_DOCS toxic documents (a stem in MIN_STEM_DOCS), however large the sample.
   Of near copies in the sample one counts, else the words of a
   copied document were terms: a document that agrees with a kept one of its label in COPY_SHARE
   of the slots of a SuperMinHash signature (an estimate of the Jaccard similarity of their
   4-word shingles with a standard deviation of at most 0.025) is left out.
   A stem must begin STEM_WORDS telling words, and no shorter stem may tell as much.
2. Matching: the lexicon is a trie; every term's Levenshtein automaton (no errors below
   MIN_FUZZY letters, one from there, two from MIN_DOUBLE) is intersected with it.  The product
   is made lazily into a deterministic automaton, whose states are the sets of (trie node,
   errors) that a prefix can reach, so a word is read once, and most words die within a few
   letters.  Stems accept any continuation.
3. Context: every hit is weighed by its term; a misspelled hit counts apart from an exact one; a
   hit inside quotation marks or on a line that starts with ``>`` counts as quoted; hits close to
   each other (WINDOW words) support each other.  Sums of these are calibrated to a probability
   by logistic regression on the sample, so how much a quotation excuses is learnt.

Every whole text is read, in the tasks that read the table.

Defined cases: null and empty texts have no hits and score as such; null ids never serve for
training; labels are used as in the quality classifier; without labels of both classes, or
without any telling term, every score is the share of toxic labels (0 without labels); ties
between terms go to the heavier, then alphabetically; other columns play no part.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import doc_crc, small_batches, written
from sediment.llm.logistic import fit_logistic, predict
from sediment.llm.near_dedup import shingle_sets, signatures
from sediment.llm.quality import labelled_sample

SAMPLE = 4000
MAX_TERMS = 3000
MIN_DOCS = 3
MIN_STEM_DOCS = 6
COPY_SLOTS = 256
COPY_SHARE = 0.8
COPY_ELEMENTS = 1 << 17
STEM_WORDS = 3
STEM = range(4, 9)
MIN_ODDS = 3.0
MIN_EVIDENCE = 12.0
MIN_FUZZY, MIN_DOUBLE = 5, 10
WINDOW = 10
MEMO = 400_000
STATES = 50_000

WORD = re.compile(r"[^\W_]+(?:[*@$!][^\W_]+)*")
QUOTES = re.compile(r'["“”«»„‟]')
BREAK = re.compile("\n")
QUOTED_LINE = re.compile(r"\s*>")


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool
    weight: float


def allowed(term: Term) -> int:
    """Errors that a term forgives."""
    n = len(term.text)
    return 0 if n < MIN_FUZZY or term.stem else 1 if n < MIN_DOUBLE else 2


class Automaton:
    """The lexicon's trie with its terms' Levenshtein automata, made deterministic lazily."""

    def __init__(self, terms: list[Term]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[Term | None] = [None]
        self.stem: list[Term | None] = [None]
        self.limit = [0]  # the most errors that a term below forgives
        for term in sorted(terms, key=lambda t: (-t.weight, t.text, t.stem)):
            node, most = 0, allowed(term)
            self.limit[0] = max(self.limit[0], most)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.limit.append(0)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], most)
            kept = self.stem if term.stem else self.term
            if kept[node] is None:
                kept[node] = term
        self._reset()

    def _reset(self) -> None:
        self.known: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[Term, int] | None] = []
        self.stems: list[Term | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of a set of (node: errors), closed under letters left out of the word."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            errors = nodes[node] + 1
            for child in self.children[node].values():
                if errors <= self.limit[child] and errors < nodes.get(child, 99):
                    nodes[child] = errors
                    todo.append(child)
        key = frozenset(nodes.items())
        if key in self.known:
            return self.known[key]
        number = self.known[key] = len(self.sets)
        ends = [(self.term[n], e) for n, e in nodes.items() if self.term[n] and e <= allowed(self.term[n])]
        stems = [self.stem[n] for n, e in nodes.items() if self.stem[n] and e == 0]
        self.sets.append(key)
        self.moves.append({})
        self.accepts.append(min(ends, key=lambda x: (x[1], -x[0].weight, x[0].text)) if ends else None)
        self.stems.append(min(stems, key=lambda x: (-x.weight, x.text)) if stems else None)
        return number

    def _move(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}

        def put(node: int, errors: int) -> None:
            if errors <= self.limit[node] and errors < nodes.get(node, 99):
                nodes[node] = errors

        for node, errors in self.sets[state]:
            put(node, errors + 1)  # a letter too many in the word
            for letter, child in self.children[node].items():
                put(child, errors + (letter != c))
        to = self._state(nodes) if nodes else -1
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[Term, int] | None:
        """The term that the word spells, with its errors: the fewest errors, then the heaviest;
        else the heaviest stem that it starts with."""
        if len(self.sets) > STATES:
            self._reset()
        state, stem = self.start, None
        for c in word:
            to = self.moves[state].get(c)
            if to is None:
                to = self._move(state, c)
            if to < 0:
                return (stem, 0) if stem else None
            state = to
            found = self.stems[state]
            if found and (stem is None or found.weight > stem.weight):
                stem = found
        end = self.accepts[state]
        if end and (stem is None or end[1] == 0):
            return end
        return (stem, 0) if stem else end


class _Memo(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str):
        if len(self) > MEMO:
            self.clear()
        self[word] = out = self.automaton.match(word)
        return out


class Quotation:
    """Where a text quotes: line starts, quotation marks and quoted lines, found once."""

    def __init__(self, text: str):
        self.text = text
        self.starts = [0, *(m.end() for m in BREAK.finditer(text))]
        self.marks = [m.start() for m in QUOTES.finditer(text)]
        self.lines = {}

    def _line(self, number: int) -> tuple[bool, int, int]:
        """Whether a line is a quoted one, and the marks before it and up to its end."""
        start = self.starts[number]
        stop = self.starts[number + 1] - 1 if number + 1 < len(self.starts) else len(self.text)
        return (QUOTED_LINE.match(self.text, start) is not None,
                bisect_right(self.marks, start - 1), bisect_right(self.marks, stop))

    def __contains__(self, at: int) -> bool:
        """Whether a word lies between an odd quotation mark and the next of its line, or on a
        quoted line."""
        number = bisect_right(self.starts, at) - 1
        if number not in self.lines:
            self.lines[number] = self._line(number)
        quoted, first, last = self.lines[number]
        here = bisect_right(self.marks, at)
        return quoted or ((here - first) % 2 == 1 and last > here)


class Reader:
    """Texts to features: weights of plain, misspelled and quoted hits, support and density."""

    def __init__(self, terms: list[Term]):
        self.memo = _Memo(Automaton(terms))

    def __call__(self, text: str) -> list[float]:
        low = text.lower()
        words = WORD.findall(low)
        matches = list(map(self.memo.__getitem__, words))
        if not any(matches):
            return [0.0] * 5
        found = [(i, m) for i, m in enumerate(matches) if m]
        places = [m.start() for m in WORD.finditer(low)]
        quotation = Quotation(low)
        plain = fuzzy = quoted = near = 0.0
        last = -WINDOW - 1
        for i, (term, errors) in found:
            w = term.weight
            if places[i] in quotation:
                quoted += w
                continue
            if errors:
                fuzzy += w / (1 + errors)
            else:
                plain += w
            if i - last <= WINDOW:
                near += w
            last = i
        return [min(1.0, plain), math.log1p(plain), math.log1p(fuzzy), math.log1p(quoted), math.log1p(near)]


def _terms(text: str) -> set[tuple[bool, str]]:
    words = set(WORD.findall(text.lower()))
    out = {(False, w) for w in words}
    for w in words:
        out.update((True, w[:n]) for n in STEM if len(w) >= n)
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each word and stem, by label, folded per batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for y, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            counts[y].update(_terms(t or ""))
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.string()),
             *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)], ["stem", "term", "n0", "n1"])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, label, text -> doc_id, label, low bytes of the signature (none of an empty set)."""
    for batch in batches:
        sets = shingle_sets([(t or "").encode() for t in batch.column(2).to_pylist()], 4)
        slots = [b""] * len(sets)
        full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
        # Bounded memory: a slice of the sets at a time.
        slices = np.cumsum([len(sets[i]) for i in full]) // COPY_ELEMENTS
        for part in np.split(full, np.flatnonzero(np.diff(slices)) + 1):
            signed = signatures([sets[i] for i in part], COPY_SLOTS) if len(part) else []
            for i, own in zip(part, signed, strict=True):
                slots[i] = (own & np.uint64(255)).astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(slots, pa.binary())],
                                         ["doc_id", "label", "slots"])


def without_copies(sample: DataFrame) -> DataFrame:
    """The sample (a bounded number of rows) without near copies of kept documents of one label;
    the smallest doc_id is kept."""
    rows = sample.mapInArrow(_signed, "doc_id long, label int, slots binary").orderBy("doc_id", "slots").collect()
    held = {y: np.zeros((n, COPY_SLOTS), np.uint8) for y, n in Counter(r["label"] for r in rows).items()}
    used, kept = Counter(), []
    for r in rows:
        if r["slots"]:
            y, own = r["label"], np.frombuffer(r["slots"], np.uint8)
            same = np.count_nonzero(held[y][:used[y]] == own, axis=1)
            if same.max(initial=0) >= COPY_SHARE * COPY_SLOTS:
                continue
            held[y][used[y]] = own
            used[y] += 1
        kept.append((r["doc_id"],))
    return sample.join(F.broadcast(sample.sparkSession.createDataFrame(kept, "doc_id long").distinct()), "doc_id")


def lexicon(sample: DataFrame, totals: dict[int, int]) -> list[Term]:
    """The telling words and stems of a labelled sample, at most MAX_TERMS of each."""
    counted = (sample.mapInArrow(_count_terms, "stem boolean, term string, n0 long, n1 long")
               .groupBy("stem", "term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    p1 = (F.col("n1") + 0.25) / (totals[1] + 0.5)
    p0 = (F.col("n0") + 0.25) / (totals[0] + 0.5)
    odds = F.log(p1 / (1 - p1)) - F.log(p0 / (1 - p0))
    share = totals[1] / (totals[0] + totals[1])
    n = F.col("n0") + F.col("n1")
    evidence = 2 * (F.col("n1") * F.log(F.greatest(F.col("n1"), F.lit(0.5)) / (n * share))
                    + F.col("n0") * F.log(F.greatest(F.col("n0"), F.lit(0.5)) / (n * (1 - share))))
    least = F.when(F.col("stem"), MIN_STEM_DOCS).otherwise(MIN_DOCS)
    telling = counted.where(F.col("n1") >= least).select("stem", "term", odds.alias("odds"),
                                                         evidence.alias("evidence")).where(
        (F.col("odds") >= MIN_ODDS) & (F.col("evidence") >= F.when(F.col("stem"), 2 * MIN_EVIDENCE)
                                       .otherwise(MIN_EVIDENCE)))
    best = [r for stem in (True, False) for r in telling.where(F.col("stem") == stem)
            .orderBy(F.desc("evidence"), "term").limit(MAX_TERMS).collect()]
    words = [r["term"] for r in best if not r["stem"]]
    out, held = [], set()
    for r in sorted(best, key=lambda r: (not r["stem"], len(r["term"]), r["term"])):
        if r["stem"]:
            shorter = any(r["term"][:k] in held for k in range(1, len(r["term"])))
            if shorter or sum(w.startswith(r["term"]) for w in words) < STEM_WORDS:
                continue
            held.add(r["term"])
        out.append(Term(r["term"], r["stem"], float(r["odds"])))
    return out


@dataclass
class Model:
    terms: list[Term]
    weights: np.ndarray | None
    base: float


def _evidence(terms: list[Term]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(terms)
        for batch in batches:
            rows = [read(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])
    return run


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic",
          usable: Column | None = None, rows: int = SAMPLE) -> Model:
    """Fit on a bounded sample: at most 2 * rows documents.

    Half of the sample makes the lexicon that the other half calibrates; the lexicon used is
    then made from the whole sample.
    """
    small_batches(docs.sparkSession)
    whole = written(labelled_sample(docs, labels, column, F.lit(True) if usable is None else usable, rows),
                    "toxic-sample")
    side = F.pmod(F.xxhash64(F.lit("side"), "doc_id"), F.lit(2))
    cells = [(s, y) for s in (0, 1) for y in (0, 1)]
    # Copies stay if a half would have no document of some label without them.
    for sample in (written(without_copies(whole), "toxic-distinct"), whole):
        got = {(r["side"], r["label"]): r["count"]
               for r in sample.groupBy(side.alias("side"), "label").count().collect()}
        if all(got.get(c) for c in cells):
            break
    totals = {y: sum(n for (_, v), n in got.items() if v == y) for y in (0, 1)}
    known = {r["label"]: r["count"] for r in labels.where(
        F.col(column).isin(0, 1) & (F.lit(True) if usable is None else usable)).groupBy(
        F.col(column).cast("int").alias("label")).count().collect()}
    base = known.get(1, 0) / sum(known.values()) if known else 0.0
    if not all(got.get(c) for c in cells):
        return Model([], None, base)
    first = lexicon(sample.where(side == 0), {y: got[0, y] for y in (0, 1)})
    if not first:
        return Model([], None, base)
    seen = (sample.where(side == 1).mapInArrow(_evidence(first), "label int, x array<double>")
            .orderBy("label", "x").collect())
    weights = fit_logistic(np.array([r["x"] for r in seen]), np.array([r["label"] for r in seen]),
                           base, ridge=1e-4)
    return Model(lexicon(sample, totals), weights, base)


def _score(model: Model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(model.terms)
        for batch in batches:
            if model.weights is None:
                out = np.full(batch.num_rows, model.base)
            else:
                rows = [read(t or "") for t in batch.column(at).to_pylist()]
                out = predict(model.weights, np.array(rows).reshape(-1, 5))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)],
                                             [*batch.schema.names, "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column score (which replaces one of that name)."""
    small_batches(docs.sparkSession)
    rows = docs.drop("score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_score(model, rows.columns.index("text")), schema + ", score double")


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels are learnt from documents whose crc32(doc_id) mod 5 is not 0."""
    model = train(docs, labels, "toxic", F.pmod(doc_crc(F.col("doc_id")), F.lit(5)) != 0)
    held = F.pmod(doc_crc(F.col("doc_id")), F.lit(5)) == 0
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
