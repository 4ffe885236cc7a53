"""Toxicity from a learned lexicon, misspellings included, read in context.

The lexicon holds whole words and word stems that labelled toxic texts use far
more than clean ones. It is a trie; its product with Levenshtein automata of
one or two edits is determinised as words are read, so a word costs a step per
letter and most words fail after two or three. Hits inside quotation marks or
near a reporting verb are counted apart from the others. A logistic regression
over the counts gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.texts import pieces
from tillsight.workspace import cut_lineage

#: Labelled documents of each class that the lexicon and the weights are fitted on, at most.
ROWS_PER_CLASS = 5_000
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
#: Evidence an entry needs: standard errors of its log odds, and the share of toxic among balanced hits.
LEAST_Z = 3.0
LEAST_PRECISION = 0.95
#: Words on each side of a hit that decide whether it is quoted.
WINDOW = 8

# Signs that open or close a quotation, and verbs that report one.
QUOTES = set("\"“”„«»")
REPORTING = {"said", "says", "wrote", "writes", "quoted", "quote", "called", "calls", "reported",
             "dit", "écrit", "sagte", "schrieb", "dijo", "escribió"}

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
FEATURES = ["words", "stems", "misspelled", "quoted", "density", "any_plain"]


def _plain(word: str) -> str:
    return _EDGES.sub("", word.lower())


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Finds the lexicon entry that a word is, begins with, or nearly is.

    Entries are words, or stems if they end in ``*``. A state is the set of
    (trie node, edits so far) pairs that the letters read can have led to.
    """

    def __init__(self, entries: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, int] = {}
        self.stem_at: set[int] = set()
        self.most_edits = [0]
        for entry in entries:
            stem, term = entry.endswith("*"), entry.rstrip("*")
            edits, node = 0 if stem else allowed_edits(term), 0
            self.most_edits[0] = max(self.most_edits[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.most_edits.append(0)
                node = self.children[node][letter]
                self.most_edits[node] = max(self.most_edits[node], edits)
            if stem:
                self.stem_at.add(node)
            else:
                self.word_at[node] = edits
        self._numbers: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._steps: list[dict[str, int]] = []
        self._accepts: list[int | None] = []
        self._is_stem: list[bool] = []
        self.start = self._number({(0, 0)})

    def _number(self, pairs: set[tuple[int, int]]) -> int:
        """The state of these pairs and of all reached by leaving out lexicon letters."""
        best: dict[int, int] = {}
        queue = list(pairs)
        while queue:
            node, edits = queue.pop()
            if edits > self.most_edits[node] and edits > 0 or best.get(node, 99) <= edits:
                continue
            best[node] = edits
            queue += [(child, edits + 1) for child in self.children[node].values()]
        state = frozenset(best.items())
        if state not in self._numbers:
            self._numbers[state] = len(self._sets)
            self._sets.append(state)
            self._steps.append({})
            ends = [e for node, e in state if e <= self.word_at.get(node, -1)]
            self._accepts.append(min(ends) if ends else None)
            self._is_stem.append(any(e == 0 and node in self.stem_at for node, e in state))
        return self._numbers[state]

    def _step(self, state: int, letter: str) -> int:
        pairs = set()
        for node, edits in self._sets[state]:
            child = self.children[node].get(letter)
            if child is not None:
                pairs.add((child, edits))
            if edits < self.most_edits[node]:
                pairs.add((node, edits + 1))
                pairs.update((other, edits + 1) for other in self.children[node].values())
        number = self._number(pairs)
        self._steps[state][letter] = number
        return number

    def match(self, word: str) -> str | None:
        """``word``, ``stem`` or ``misspelled``, or None."""
        state, stem = self.start, False
        for letter in word:
            following = self._steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            stem = stem or self._is_stem[state]
            if not self._sets[state]:
                return "stem" if stem else None
        edits = self._accepts[state]
        if edits == 0:
            return "word"
        return "stem" if stem else None if edits is None else "misspelled"


class Reader:
    """Counts the hits of texts; keeps what it found out about words seen before."""

    def __init__(self, entries: list[str], memory: int = 200_000):
        self.automaton = LexiconAutomaton(entries)
        self._known: dict[str, str | None] = {}
        self._memory = memory

    def kind(self, word: str) -> str | None:
        if word in self._known:
            return self._known[word]
        if len(self._known) >= self._memory:
            self._known.clear()
        found = self._known[word] = self.automaton.match(_plain(word))
        return found

    def features(self, text: str) -> list[float]:
        words = text.split()
        known, kind = self._known, self.kind
        hits = [
            (at, found)
            for at, word in enumerate(words)
            if (found := known[word] if word in known else kind(word)) is not None
        ]
        if not hits:
            return [0.0] * len(FEATURES)
        counts = Counter()
        for at, found in hits:
            counts["quoted" if self._quoted(words, at) else found] += 1
        plain = counts["word"] + counts["stem"] + counts["misspelled"]
        return [
            math.log1p(counts["word"]), math.log1p(counts["stem"]),
            math.log1p(counts["misspelled"]), math.log1p(counts["quoted"]),
            math.log1p(100 * plain / len(words)), float(plain > 0),
        ]

    @staticmethod
    def _quoted(words: list[str], at: int) -> bool:
        """A sign of quotation on both sides within the window, or a reporting verb before it."""
        before, after = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
        here = words[at]
        opened = any(QUOTES & set(word) for word in before) or here[:1] in QUOTES
        closed = any(QUOTES & set(word) for word in after) or bool(QUOTES & set(here[1:]))
        return opened and closed or any(_plain(word) in REPORTING for word in before)


def _term_counts(batches):
    """Documents of each class that have a term: whole words, and stems marked by ``*``."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for piece in pieces(batches):
        for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
            words = {_plain(word) for word in (text or "").split()}
            terms = {word for word in words if len(word) >= STEM_LENGTHS[0]}
            for length in STEM_LENGTHS:
                terms |= {word[:length] + "*" for word in words if len(word) > length}
            counts[toxic].update(terms)
    clean, toxic = counts
    terms = list(set(clean) | set(toxic))
    yield pa.record_batch([
        pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()),
        pa.array([clean[t] for t in terms], pa.int64()),
    ], names=["term", "toxic", "clean"])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> DataFrame:
    """(text, toxic) of at most ``rows`` training documents of each class, stored.

    Those with the smallest hash of their id; none whose id is held out.
    """
    known = labels.filter("doc_id is not null and toxic in (0, 1)").select(
        F.col("doc_id").cast("bigint").alias("_id"), F.col("toxic").cast("int").alias("toxic")
    )
    known = known.filter(~held_out("_id")).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    picked = [
        known.filter(F.col("toxic") == value).orderBy(F.xxhash64("_id"), "_id").limit(rows)
        for value in (0, 1)
    ]
    ids = F.broadcast(picked[0].union(picked[1]))
    sample = docs.join(ids, docs["doc_id"] == ids["_id"]).select(
        F.col("text").cast("string").alias("text"), "toxic"
    )
    return cut_lineage(sample, "toxicity-sample")


def held_out(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def learn_lexicon(sample: DataFrame) -> list[str]:
    """Terms that speak for a toxic text, strongest first.

    All of them: they are words of the sample, whose rows are bounded.
    """
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return []
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    others, cleans = sizes[1] + 1 - toxic, sizes[0] + 1 - clean
    odds = F.log(toxic / others) - F.log(clean / cleans)
    error = F.sqrt(1 / toxic + 1 / others + 1 / clean + 1 / cleans)
    share = toxic / sizes[1] / (toxic / sizes[1] + clean / sizes[0])
    terms = (
        sample.mapInArrow(_term_counts, "term string, toxic bigint, clean bigint")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter("toxic >= 3")
        .select("term", "toxic", (odds / error).alias("z"), share.alias("share"))
        .filter((F.col("z") >= LEAST_Z) & (F.col("share") >= LEAST_PRECISION))
        .orderBy(F.desc("z"), "term")
        .collect()
    )
    counts = {row["term"]: row["toxic"] for row in terms}
    stems = {term[:-1] for term in counts if term.endswith("*")}

    most: Counter = Counter()
    for term, found in counts.items():
        if not term.endswith("*"):
            for length in STEM_LENGTHS:
                most[term[:length]] = max(most[term[:length]], found)

    def needless(stem: str) -> bool:
        """A shorter stem covers it, or one whole word is nearly all that it finds."""
        return any(stem[:n] in stems for n in range(STEM_LENGTHS[0], len(stem))) or (
            most[stem] > 0 and 10 * most[stem] >= 9 * counts[stem + "*"]
        )

    return [term for term in counts if not (term.endswith("*") and needless(term[:-1]))]


def fit_weights(features: np.ndarray, toxic: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the intercept, unpenalised."""
    inputs = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(inputs.shape[1])
    ridge = np.diag([penalty] * features.shape[1] + [1e-6])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (chance - toxic) + ridge @ weights
        curve = (inputs * (chance * (1 - chance) + 1e-9)[:, None]).T @ inputs + ridge
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _featured(entries: list[str], keep: list[str]):
    """The columns ``keep`` and the features of each text; a null text is empty."""

    def run(batches):
        reader = Reader(entries)
        for piece in pieces(batches):
            rows = [reader.features(text or "") for text in piece.column("text").to_pylist()]
            table = np.array(rows, dtype=float).reshape(piece.num_rows, len(FEATURES))
            yield pa.record_batch(
                [*(piece.column(name) for name in keep), *(pa.array(x) for x in table.T)],
                names=[*keep, *FEATURES],
            )

    return run


_FEATURE_COLUMNS = ", ".join(f"{name} double" for name in FEATURES)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``held_out``, ``score`` from 0 to 1, ``predicted``, and the hit counts.

    A null or empty text has no hits and scores as the weights' intercept says.
    Without labels of both classes every score is 0. A null id is not held out.
    Rows that share an id are scored one by one.
    """
    needed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    sample = labelled_sample(needed, labels)
    entries = learn_lexicon(sample)
    fitted = sample.mapInArrow(
        _featured(entries, ["toxic"]), f"toxic int, {_FEATURE_COLUMNS}"
    ).toPandas()
    toxic = fitted["toxic"].to_numpy(dtype=float)
    if 0 < toxic.sum() < len(toxic):
        *weights, intercept = fit_weights(fitted[FEATURES].to_numpy(dtype=float), toxic).tolist()
        total = sum((F.col(n) * w for n, w in zip(FEATURES, weights)), F.lit(float(intercept)))
        score = 1 / (1 + F.exp(-total))
    else:
        score = F.lit(0.0)
    found = needed.mapInArrow(
        _featured(entries, ["doc_id"]), f"doc_id bigint, {_FEATURE_COLUMNS}"
    ).withColumn("score", score)
    return found.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *[F.round(F.expm1(n)).cast("bigint").alias(f"n_{n}") for n in ("words", "stems", "misspelled", "quoted")],
    )
