"""Toxicity: a learnt lexicon, matched with misspellings, read in its context.

The lexicon is learnt from labelled training rows: whole words and word stems
(prefixes) that toxic documents hold far oftener than clean ones. Its terms stand in a trie. A Levenshtein automaton for every
term at once is intersected with the trie: a state is the set of trie nodes that
can be reached with their numbers of errors, states are made as words need them
and are remembered, and most words leave the automaton within a few letters.

Each match is weighed by the log-odds that its term has at that distance in
training documents; ordinary words that merely resemble a term, as clean documents
show, weigh nothing. The window around it tells how it is used: between quotation marks or
behind a verb of report it counts less, next to an address of the reader more.
A logistic curve over a document's summed and strongest weights gives the score.

The lexicon and the curve are fitted on a bounded sample of labelled training
rows, ``TOXIC_ROWS`` and ``CLEAN_ROWS``, those of the smallest hashes, as long as
their texts take ``SAMPLE_BYTES`` in all; whole texts of all rows are scored.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import held_out, stored, without
from sieveline.llm.tokens import text_blocks

#: What is learnt from comes to the driver: so many rows of either label, and bytes of text for each label.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_BYTES = 1_000, 2_000, 32 << 20
THRESHOLD = 0.5
#: A term marks at least so many toxic documents, this many times as often as clean ones.
LEAST_DOCS, LEAST_SHARE, LEAST_LIFT = 3, 0.01, 15.0
#: Of terms in this share of the toxic documents less is asked.
COMMON, COMMON_DOCS, COMMON_LIFT = 0.03, 12, 4.0
#: Words that a stem must have begun.
LEAST_ENDINGS = 3
#: Clean documents that make a word that resembles a term an ordinary one.
SPARED_DOCS = 2
#: Near copies are told by words of so many letters, in so many orders.
LONG, BANDS = 8, 5
#: Letters a term needs for one and for two errors.
ONE_ERROR, TWO_ERRORS = 5, 9
STEM = 4
#: Words on either side of a match that tell its use.
WINDOW = 8
QUOTED, REPORTED, ADDRESSED = 0.35, 0.6, 1.25
CACHE_WORDS = 200_000

QUOTES = re.compile("[\"“”„«»‹›]")
CHUNKS = re.compile(r"[^ \t\n\r\f\v]+")
#: Marks that end a quotation, with those that may have begun it. A mark that ends nothing begins one
#: if it is listed here as a beginning.
ENDS = {"”": "“„", "“": "„", "»": "«", "«": "»", "›": "‹", "‹": "›"}
BEGINS = "“„«»‹›"
REPORTS = frozenset("said says say wrote writes quoted quote quotes called reported reports according dijo dice escribió dit écrit sagte sagt schrieb".split())
ADDRESS = frozenset("you your you're u ur yourself du dich dein sie ihr tu te tú usted toi vous votre".split())
_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "“”„«»‹›‘’¡¿…–—"


def plain(chunk: str) -> str:
    """The word without marks at its ends, lower-cased."""
    return chunk.strip(_EDGE).lower()


def quotations(text: str) -> list[tuple[int, int]]:
    """Where the text's quotations begin and end, in order of their ends.

    Marks with a side are taken by it. A straight mark begins a quotation after white space, a
    bracket or at the start, if a word follows, and ends one after a word. A mark that nothing
    ends quotes nothing, as doesn't one that ends what has not begun.
    """
    opened: dict[str, int] = {}
    found = []
    for mark in QUOTES.finditer(text):
        m, at = mark.group(), mark.start()
        before, after = text[at - 1 : at] if at else "", text[at + 1 : at + 2]
        if m == '"':
            if m in opened and before.strip():
                found.append((opened.pop(m), at))
            elif (not before.strip() or before in "([{—–-:") and after.strip():
                opened[m] = at
            continue
        begun = [b for b in ENDS[m] if b in opened] if m in ENDS else []
        if begun:
            found.append((max(opened.pop(b) for b in begun), at))
        elif m in BEGINS:
            opened[m] = at
    return found


class _State:
    __slots__ = ("cells", "next", "hits")

    def __init__(self, cells: frozenset, hits: tuple):
        self.cells, self.next, self.hits = cells, {}, hits


class Automaton:
    """The Levenshtein automata of all terms, intersected with their trie. ``terms``
    are words, or stems with a ``*`` behind them, which any ending may follow."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]  # terms that end at a node
        self.most: list[int] = [0]  # errors that some term below allows
        self.allowed = []
        for number, term in enumerate(terms):
            body = term.rstrip("*")
            allowed = 2 if len(body) >= TWO_ERRORS and body == term else 1 if len(body) >= ONE_ERROR + (body != term) else 0
            self.allowed.append(allowed)
            at = 0
            self.most[0] = max(self.most[0], allowed)
            for letter in body:
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                at = self.children[at][letter]
                self.most[at] = max(self.most[at], allowed)
            self.ends[at].append(number)
        self._states: dict[frozenset, _State] = {}
        self.start = self._state({(0, 0)})

    def _state(self, cells: set) -> _State:
        """cells: (node, errors), and (-1 - term, errors) for a stem that is complete."""
        stack = list(cells)
        while stack:  # a letter of the term that the word lacks
            node, errors = stack.pop()
            if node >= 0:
                for below in self.children[node].values():
                    cell = (below, errors + 1)
                    if errors < self.most[below] and cell not in cells:
                        cells.add(cell)
                        stack.append(cell)
        for node, errors in list(cells):
            if node >= 0:
                cells |= {(-1 - t, errors) for t in self.ends[node] if self.terms[t].endswith("*") and errors <= self.allowed[t]}
        key = frozenset(cells)
        if key not in self._states:
            best: dict[int, int] = {}
            for node, errors in cells:
                for t in self.ends[node] if node >= 0 else [-1 - node]:
                    if errors <= self.allowed[t]:
                        best[t] = min(errors, best.get(t, 9))
            self._states[key] = _State(key, tuple(sorted((e, t) for t, e in best.items())))
        return self._states[key]

    def _step(self, state: _State, letter: str) -> _State | None:
        cells = set()
        for node, errors in state.cells:
            if node < 0:
                cells.add((node, errors))
                continue
            if errors < self.most[node]:  # a letter too many
                cells.add((node, errors + 1))
            for known, below in self.children[node].items():
                if known == letter:
                    cells.add((below, errors))
                elif errors < self.most[below]:
                    cells.add((below, errors + 1))
        state.next[letter] = made = self._state(cells) if cells else None
        return made

    def match(self, word: str) -> tuple[tuple[int, int], ...]:
        """(errors, term) of each term within its errors of the word, the nearest first."""
        state: _State | None = self.start
        for letter in word:
            after = state.next
            state = after[letter] if letter in after else self._step(state, letter)
            if state is None:
                return ()
        return state.hits


class _Matches(dict):
    """Each chunk's match: 0 for none, else a number into ``found``."""

    def __init__(self, automaton: Automaton, weights: dict[tuple[int, int], float], spared: frozenset[str]):
        super().__init__()
        self.automaton, self.weights, self.spared = automaton, weights, spared
        self.found: list[tuple[float, int, int]] = [(0.0, 0, 0)]

    def __missing__(self, chunk: bytes) -> int:
        word = plain(chunk.decode("utf-8", "replace"))
        best = max(((self.weights.get((e, t), 0.0), -e, t) for e, t in self.automaton.match(word) if not e or word not in self.spared), default=(0.0, 0, 0))
        number = 0
        if best[0] > 0:
            number = len(self.found)
            self.found.append((best[0], -best[1], best[2]))
        self[chunk] = number
        return number


class Scorer:
    """A lexicon with weights, and the curve."""

    def __init__(self, terms: list[str], weights: dict[tuple[int, int], float], curve: list[float], share: float, spared: frozenset[str] = frozenset()):
        self.terms, self.weights, self.curve, self.share, self.spared = terms, weights, curve, share, spared
        self._matches: _Matches | None = None

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "curve": self.curve, "share": self.share, "spared": self.spared, "_matches": None}

    def forget(self) -> None:
        """Drop the words remembered."""
        self._matches = None

    def _context(self, chunks: list[bytes], at: int, quoted: bool) -> float:
        before = [c.decode("utf-8", "replace") for c in chunks[max(0, at - WINDOW) : at]]
        after = [c.decode("utf-8", "replace") for c in chunks[at + 1 : at + 1 + WINDOW]]
        factor = 1.0
        if quoted:
            factor *= QUOTED
        elif any(plain(w) in REPORTS for w in before[-4:]):
            factor *= REPORTED
        if any(plain(w) in ADDRESS for w in before[-3:] + after[:3]):
            factor *= ADDRESSED
        return factor

    @staticmethod
    def _quoted(text: str, numbers: np.ndarray) -> list[bool]:
        """Which of the text's words, by ascending number, lie within a quotation."""
        spans = quotations(text)
        if not spans:
            return [False] * len(numbers)
        begins, ends = (np.array(x) for x in zip(*sorted(spans), strict=True))
        ends = np.maximum.accumulate(ends)
        words = np.array([m.span() for m in CHUNKS.finditer(text)])[numbers]
        at = np.searchsorted(begins, words[:, 1] - 1) - 1
        return ((at >= 0) & (ends[at] > words[:, 0])).tolist()

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, list[int]]:
        """Per text: summed weight (in logs), strongest weight, 1; and its number of matches."""
        if self._matches is None or len(self._matches) > CACHE_WORDS:
            self._matches = _Matches(Automaton(self.terms), self.weights, self.spared)
        chunks: list[bytes] = []
        edges = [0]
        for text in texts:
            chunks += (text or "").encode().split()
            edges.append(len(chunks))
        codes = np.fromiter(map(self._matches.__getitem__, chunks), np.int64, len(chunks))
        x, n = np.zeros((len(texts), 3)), [0] * len(texts)
        x[:, 2] = 1
        hits = np.flatnonzero(codes)
        owners = np.searchsorted(edges, hits, "right") - 1
        quoted = [q for i in np.unique(owners).tolist() for q in self._quoted(texts[i], hits[owners == i] - edges[i])]
        for i, at, within in zip(owners.tolist(), hits.tolist(), quoted, strict=True):
            near = chunks[max(edges[i], at - WINDOW) : edges[i + 1] if at + WINDOW + 1 > edges[i + 1] else at + WINDOW + 1]
            weight = self._matches.found[codes[at]][0] * self._context(near, at - max(edges[i], at - WINDOW), within)
            x[i, 0] += weight
            x[i, 1] = max(x[i, 1], weight)
            n[i] += 1
        x[:, 0] = np.log1p(x[:, 0])
        return x, n

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.curve:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -60, 60)))


def _words(text: str | None) -> tuple[str, ...]:
    """The distinct words; equal ones of many texts are one object, as the driver holds a sample's."""
    return tuple({sys.intern(w) for c in set((text or "").split()) if (w := plain(c))})


def _families(documents: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Near copies made one, their words together: documents that share the two least
    hashes of their long words, in one of BANDS orders. Else the words of a text
    with many copies would look like terms."""
    parent = list(range(len(documents)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[tuple, int] = {}
    for i, words in enumerate(documents):
        if len(long := [w.encode() for w in words if len(w) >= LONG]) < 2:
            continue
        for band in range(BANDS):
            key = (band, *sorted(xxhash.xxh64_intdigest(w, band) for w in long)[:2])
            parent[find(i)] = find(first.setdefault(key, i))
    families: dict[int, list[int]] = defaultdict(list)
    for i in range(len(documents)):
        families[find(i)].append(i)
    return [documents[own[0]] if len(own) == 1 else tuple(set().union(*(documents[i] for i in own))) for own in families.values()]


def _terms(words: tuple[str, ...]) -> set[str]:
    """The words and their stems."""
    return {t for w in words for t in (w, *(w[:k] + "*" for k in range(STEM, len(w))))}


def learn_lexicon(toxic: list[tuple[str, ...]], clean: list[tuple[str, ...]]) -> list[str]:
    """Words and stems (``stem*``) that mark toxic documents, the commonest first. A
    term is left out if shorter or longer forms of it leave it too few documents of
    its own."""
    n1, n0 = max(1, len(toxic)), max(1, len(clean))
    least = max(LEAST_DOCS, LEAST_SHARE * n1)
    # a sketch of the terms' counts tells which can be common enough; only those are held
    sketch = np.zeros(1 << 22, np.int32)
    for words in toxic:
        sketch[np.fromiter({hash(t) & 0x3FFFFF for t in _terms(words)}, np.int64)] += 1
    holders: dict[str, set[int]] = defaultdict(set)
    endings: dict[str, set[str]] = defaultdict(set)
    for i, words in enumerate(toxic):
        for word in words:
            if sketch[hash(word) & 0x3FFFFF] >= least:
                holders[word].add(i)
            for k in range(STEM, len(word)):
                stem = word[:k] + "*"
                if sketch[hash(stem) & 0x3FFFFF] < least:
                    break  # a longer stem has no more documents
                holders[stem].add(i)
                endings[stem].add(word)
    holders = {t: d for t, d in holders.items() if len(d) >= least and (not t.endswith("*") or len(endings[t]) >= LEAST_ENDINGS)}
    against: Counter[str] = Counter()
    for words in clean:
        against.update(t for t in _terms(words) if t in holders)
    good = [t for t, d in holders.items() if (len(d) / n1) / ((against[t] + 0.5) / n0) >= (COMMON_LIFT if len(d) >= max(COMMON_DOCS, COMMON * n1) else LEAST_LIFT)]
    good.sort(key=lambda t: (3 * against[t] / n0 - len(holders[t]) / n1, t.endswith("*"), -len(t), t))
    chosen: list[str] = []
    by_start: dict[str, list[str]] = defaultdict(list)  # chosen terms by their first letters
    for term in good:
        body = term.rstrip("*")
        related = [c for c in by_start[body[:STEM]] if c.rstrip("*").startswith(body) or body.startswith(c.rstrip("*"))]
        if len(holders[term].difference(*(holders[c] for c in related))) >= least:
            chosen.append(term)
            by_start[body[:STEM]].append(term)
    return chosen


def weigh(terms: list[str], toxic: list[tuple[str, ...]], clean: list[tuple[str, ...]]) -> tuple[dict[tuple[int, int], float], frozenset[str]]:
    """The log-odds of each (errors, term) by the documents that hold such a match, and
    the words that only resemble a term: those that several clean documents hold, and
    toxic ones no oftener. What resembles a term and was never met weighs less than the term."""
    automaton = Automaton(terms)
    n1, n0 = max(1, len(toxic)), max(1, len(clean))
    found: dict[str, tuple] = {}
    held: list[Counter] = [Counter(), Counter()]
    for k, documents in ((1, toxic), (0, clean)):
        for words in documents:
            for word in words:
                if word not in found:
                    found[word] = automaton.match(word)
                if found[word]:
                    held[k][word] += 1
    alike = {w for w in held[0] if found[w][0][0] > 0}
    spared = frozenset(w for w in alike if held[0][w] >= SPARED_DOCS and held[1][w] / n1 < LEAST_LIFT * held[0][w] / n0)
    by1, by0 = (Counter() for _ in range(2))
    for k, documents, total in ((1, toxic, by1), (0, clean, by0)):
        for words in documents:
            total.update({m for w in words if w in held[k] and w not in spared for m in found[w]})
    weights = {}
    for errors, term in {(e, t) for t, k in enumerate(automaton.allowed) for e in range(k + 1)}:
        key = (errors, term)
        if by1[key] + by0[key]:
            odds = math.log((by1[key] + 0.5) / (n1 + 1)) - math.log((by0[key] + 0.5) / (n0 + 1))
        else:
            own = math.log((by1[(0, term)] + 0.5) / (n1 + 1)) - math.log((by0[(0, term)] + 0.5) / (n0 + 1))
            odds = own * 0.6**errors
        weights[key] = odds if odds >= 1 else 0.0
    return weights, spared


def _curve(x: np.ndarray, y: np.ndarray) -> list[float]:
    b, pull = np.zeros(x.shape[1]), np.diag([0.05, 0.05, 1e-4])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (p - y) + pull @ b)
        b = b - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return b.tolist()


def fit(sample: list[tuple[str | None, int]]) -> Scorer:
    """sample: (text, label). Without rows of both labels every score is the share of label 1."""
    toxic, clean = (_families([_words(t) for t, y in sample if y == k]) for k in (1, 0))
    share = len(toxic) / len(sample) if sample else 0.5
    if not toxic or not clean:
        return Scorer([], {}, [], share)
    terms = learn_lexicon(toxic, clean)
    weights, spared = weigh(terms, toxic, clean)
    scorer = Scorer(terms, weights, [], share, spared)
    x, _ = scorer.features([t for t, _ in sample])
    scorer.curve = _curve(x, np.array([y for _, y in sample], float))
    scorer.forget()
    return scorer


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Scorer:
    """The scorer learnt from a bounded sample of the labelled rows that aren't held out.
    Of several texts of an id the least is learnt from. Texts of more than ``sample_bytes`` are passed
    over; of the others a label takes as many, in the order of their hash, as have so many bytes in all."""
    marked = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y IN (0, 1)").groupBy("__id").agg(F.max("y").alias("y"))
    marked = marked.where(F.col("__id").isNotNull() & ~held_out(F.col("__id")))
    parts = [marked.where(F.col("y") == k).orderBy(F.xxhash64("__id"), "__id").limit(n) for k, n in ((1, toxic_rows), (0, clean_rows))]
    chosen = stored(parts[0].unionAll(parts[1]), "sample")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    own = stored(texts.join(F.broadcast(chosen), F.col("id") == F.col("__id")).groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y")), "texts")
    # lengths alone meet in a window, of toxic_rows or clean_rows rows at most
    lengths = own.select("id", "y", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).where(F.col("n") <= sample_bytes)
    so_far = F.sum("n").over(Window.partitionBy("y").orderBy(F.xxhash64("id"), "id"))
    fitting = lengths.withColumn("bytes", so_far).where(F.col("bytes") <= sample_bytes).select("id")
    rows = own.join(F.broadcast(fitting), "id").select("id", "text", "y").collect()
    return fit([(r["text"], r["y"]) for r in sorted(rows, key=lambda r: r["id"])])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted and n_matches of every row.

    Labels other than 0 and 1 count as none, and of several labels of an id the
    largest counts. Null or empty text has no matches and is scored all the same.
    Rows with a null id are scored and never learnt from. Repeated rows stay. If the
    sample lacks a label, every score is the sample's share of label 1 (0.5 without rows).
    Very long texts are scored whole. An empty table gives no rows. Other columns take no part.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = scorer.value
        for batch, texts in text_blocks(batches, "__text"):
            x, n = model.features(texts)
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32)), pa.array(n, pa.int64())], ["doc_id", "score", "predicted", "n_matches"])
        model.forget()  # the worker lives on, for other operators

    scored = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, "doc_id long, score double, predicted int, n_matches long")
    return stored(scored, "scores").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_matches")


def drop_toxic(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without those scored toxic; rows with a null id stay."""
    found = score_toxicity(docs, labels, id_col=id_col, threshold=threshold, **options)
    return without(docs, id_col, stored(found.where("predicted = 1 AND doc_id IS NOT NULL").select("doc_id").distinct(), "toxic"))
