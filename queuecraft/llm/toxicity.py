"""Toxicity scores: misspelled lexicon terms found by Levenshtein automata over a trie, weighed by their context."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import documents
from queuecraft.llm.registry import query

END = "\n"               # closes a term that is a whole word; a term without it is an open stem
TOXIC_SAMPLE = 4_000     # labelled documents the model is fitted on, at most, by class
CLEAN_SAMPLE = 8_000
SHORTEST, LONGEST = 4, 14
SHORTEST_WORD = 3        # of terms that are whole words and allow no edit
CHANCE = 1e-6            # a term is kept if its toxic documents would fall together by chance this rarely,
RATIO = 10               # and if it stands this many times as often in toxic documents as in others
CACHED_WORDS = 300_000   # a worker's word table is emptied beyond this; it only saves repeated work
WINDOW = 6               # words on each side that decide whether a hit is quoted
TRIM = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…|"
OPENING, CLOSING = "\"“„«'‘", "\"”“»'’"
# fixed values: words that report somebody else's speech
REPORTING = frozenset("said says quote quoted quotes wrote writes called calling word words term insult slur".split())


class Lexicon:
    """The trie of terms and its product with Levenshtein automata, made deterministic as words ask for it.

    A state holds the (trie node, edits) pairs that some spelling of the word read so far can reach. Open stems under
    6 and whole words under 5 characters and words with other characters than letters allow no edit, others one, whole
    words of 9 and more two; the first character always holds.
    """

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [-1]      # edits a term that ends here may have, -1 if none ends
        self.below: list[int] = [0]         # most edits of any term below
        for term in sorted(terms):
            node, word = 0, term.rstrip(END)
            closed = term.endswith(END)
            edits = 0 if len(word) < 6 - closed or not word.isalpha() else 2 if len(word) >= 9 and closed else 1
            for ch in term:
                self.below[node] = max(self.below[node], edits)
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.allowed.append(-1)
                    self.below.append(0)
                node = self.children[node][ch]
            self.below[node] = max(self.below[node], edits)
            self.allowed[node] = max(self.allowed[node], edits)
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.verdicts: list[int] = []       # least edits of an open stem already read, -1 if none
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        todo, best = list(pairs), {}
        while todo:
            node, edits = todo.pop()
            if edits > self.below[node] or best.get(node, 9) <= edits:
                continue
            best[node] = edits
            if node:        # a character of the term that the word leaves out
                todo += [(child, edits + 1) for ch, child in self.children[node].items() if ch != END]
        key = frozenset(best.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            done = [e for n, e in key if e <= self.allowed[n]]
            self.verdicts.append(min(done, default=-1))
        return self.numbers[key]

    def _step(self, state: int, ch: str) -> int:
        pairs = set()
        for node, edits in self.states[state]:
            for other, child in self.children[node].items():
                if other == ch:
                    pairs.add((child, edits))
                elif node and other != END and ch != END:
                    pairs.add((child, edits + 1))
            if node and ch != END:
                pairs.add((node, edits + 1))        # a character that the word has besides
        out = self._state(pairs)
        self.steps[state][ch] = out
        return out

    def edits(self, word: str) -> int:
        """Fewest edits between ``word`` and a term it matches, -1 if it matches none."""
        state, best, empty = self.start, 9, frozenset()
        for ch in word + END:
            step = self.steps[state].get(ch)
            state = self._step(state, ch) if step is None else step
            if self.states[state] == empty:
                break
            if 0 <= self.verdicts[state] < best:
                best = self.verdicts[state]
                if best == 0:
                    break
        return -1 if best == 9 else best


def word_table(lexicon: Lexicon, words: set[str], known: dict[str, int]) -> None:
    if len(known) > CACHED_WORDS:
        known.clear()
    for word in words:
        if word not in known:
            bare = word.strip(TRIM)
            known[word] = lexicon.edits(bare) if len(bare) >= SHORTEST_WORD else -1


def quoted(words: list[str], at: int) -> bool:
    """Whether the hit stands in quotation: marks that open before and close after it, or a reporting word before."""
    before, after = words[max(0, at - WINDOW):at + 1], words[at:at + WINDOW + 1]
    opened = closed = False
    for w in before:
        if w[0] in OPENING:
            opened = True
        elif w is not before[-1] and w.rstrip(".,;:!?")[-1:] and w.rstrip(".,;:!?")[-1] in CLOSING:
            opened = False
    for w in after:
        tail = w.rstrip(".,;:!?")
        if tail and tail[-1] in CLOSING:
            closed = True
            break
    return opened and closed or any(w.strip(TRIM) in REPORTING for w in before[:-1])


#: What a document is judged by: a constant, hits by kind, hits per word.
FEATURES = ("one", "exact", "exact_quoted", "near", "near_quoted", "share")
#: Where the weights are drawn to when labels say nothing about them.
PRIOR = np.array([-3.0, 2.5, 0.4, 1.5, 0.2, 1.0])


def features(words: list[str], known: dict[str, int]) -> list[float]:
    counts = [0, 0, 0, 0]
    for at, edits in enumerate(map(known.__getitem__, words)):
        if edits >= 0:
            counts[(2 if edits else 0) + quoted(words, at)] += 1
    hits = counts[0] + counts[2]
    return [1.0, *[math.log2(1 + c) for c in counts], math.log2(1 + 100 * hits / max(len(words), 1))]


def split(text: str | None) -> list[str]:
    return (text or "").lower().split()


def prefixes(words: set[str]) -> set[str]:
    out = set()
    for word in words:
        word = word.strip(TRIM)
        if len(word) >= SHORTEST and word.isalpha():
            word = word[:LONGEST] + (END if len(word) <= LONGEST else "")
            out.update(word[:i] for i in range(SHORTEST, len(word) + 1))
        elif len(word) >= SHORTEST_WORD:
            out.add(word + END)
    return out


def count_prefixes(only: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = prefixes(set(split(text)))
                counts.update(own if only is None else own & only)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())],
                                         names=["prefix", "n"])
    return run


def by_chance(toxic: int, clean: int, base: float) -> float:
    """Chernoff's bound on the log chance that so many of a term's documents are toxic; exact where all are."""
    share = toxic / (toxic + clean)
    if share <= base:
        return 0.0
    rest = clean * math.log((1 - base) / (1 - share)) if clean else 0.0
    return toxic * math.log(base / share) + rest


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> list[str]:
    """Terms from prefix counts: shortest telling prefixes, drawn out while nearly all their documents go on alike.

    Clean documents may hold a term, as quotations do: what its hits weigh there is left to the features.
    """
    base = (n_toxic + 1) / (n_toxic + n_clean + 2)
    telling = {p for p, n in toxic.items() if by_chance(n, clean.get(p, 0), base) <= math.log(CHANCE)
               and clean.get(p, 0) * n_toxic * RATIO <= n * n_clean}
    shortest = [p for p in telling if not any(p[:i] in telling for i in range(SHORTEST, len(p)))]
    out = set()
    for term in shortest:
        while not term.endswith(END):
            longer = [p for p in toxic if len(p) == len(term) + 1 and p.startswith(term)
                      and toxic[p] >= 0.95 * toxic[term]]
            if not longer:
                break
            term = longer[0]
        out.add(term)
    return sorted(out)


def chance(z: np.ndarray) -> np.ndarray:
    """The logistic function, without overflow at either end."""
    return (1 + np.tanh(z / 2)) / 2


def fit_weights(rows: np.ndarray, labels: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton steps, drawn towards PRIOR; labels with a class missing leave it as it is.

    A step is halved until the loss falls, so separable labels cannot throw the weights about.
    """
    def loss(w: np.ndarray) -> float:
        z = rows @ w
        return float((np.logaddexp(0, z) - labels * z).sum() + pull / 2 * ((w - PRIOR) ** 2).sum())

    weights = PRIOR.copy()
    for _ in range(200):
        p = chance(rows @ weights)
        slope = rows.T @ (p - labels) + pull * (weights - PRIOR)
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + pull * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        now = loss(weights)
        while loss(weights - step) > now and np.abs(step).max() >= 1e-8:
            step = step / 2
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def scorer(terms: list[str], weights: list[float] | None):
    """Arrow function: (doc_id, text) to (doc_id, score), or to the features where no weights are given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, known = Lexicon(terms), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                words = [split(t) for t in part.column(1).to_pylist()]
                word_table(lexicon, set().union(*words), known)
                found = np.array([features(w, known) for w in words])
                values = (pa.array(found.tolist(), pa.list_(pa.float64())) if weights is None
                          else pa.array(chance(found @ np.array(weights))))
                yield pa.RecordBatch.from_arrays([part.column(0), values], names=["doc_id", "value"])
    return run


def fit(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[float]]:
    """Lexicon and weights from labelled rows whose crc32(doc_id) mod 3 is not 1.

    At most TOXIC_SAMPLE toxic and CLEAN_SAMPLE other documents, in the order of a hash of their id, are read; the
    lexicon and the weights that go to the workers are small whatever the corpus. Null labels are left out; of several
    labels of one id the highest holds.
    """
    usable = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("_toxic")))
    def sample(toxic: int, size: int) -> DataFrame:
        ids = usable.where(F.col("_toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")   # at most ``size`` rows
    bad, good = sample(1, TOXIC_SAMPLE), sample(0, CLEAN_SAMPLE)
    def counted(frame: DataFrame, only: frozenset[str] | None, least: int) -> dict[str, int]:
        rows = (frame.select("text").distinct().mapInArrow(count_prefixes(only), "prefix string, n long")
                .groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
        return {r.prefix: r.n for r in rows.collect()}
    n_bad, n_good = bad.select("text").distinct().count(), good.select("text").distinct().count()
    base = (n_bad + 1) / (n_bad + n_good + 2)
    least = max(3, math.ceil(math.log(CHANCE) / math.log(base)))
    in_bad = counted(bad, None, least)
    in_good = counted(good, frozenset(in_bad), 1) if in_bad else {}
    terms = choose_terms(in_bad, in_good, n_bad, n_good)
    read = scorer(terms, None)
    rows = []
    for y, frame in ((1, bad), (0, good)):
        got = frame.select("doc_id", "text").mapInArrow(read, f"doc_id {_kind(docs)}, value array<double>").collect()
        rows += [(r.value, y) for r in got]
    if not rows:
        return terms, PRIOR.tolist()
    return terms, fit_weights(np.array([v for v, _ in rows]), np.array([y for _, y in rows], float)).tolist()


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row: probability that the text is toxic, from its words alone.

    Null and empty texts score as texts without a hit. Repeated rows score alike. Without labelled rows the lexicon
    is empty and all scores are that of a text without a hit; an empty table gives an empty result.
    """
    terms, weights = fit(docs, labels)
    return docs.select("doc_id", "text").mapInArrow(
        scorer(terms, weights), f"doc_id {_kind(docs)}, value double").withColumnRenamed("value", "score")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns as they are."""
    terms, weights = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, known = Lexicon(terms), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                words = [split(t) for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                word_table(lexicon, set().union(*words), known)
                found = np.array([features(w, known) for w in words])
                yield part.filter(pa.array(1 / (1 + np.exp(-found @ np.array(weights))) < threshold))
    return docs.mapInArrow(run, docs.schema)


@query("op2_lexicon_automata")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return score(documents(spark, sf), labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))
