"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over words."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import documents, with_text
from queuecraft.llm.registry import query
from queuecraft.llm.spans import ARROW, SPANS, digest_columns, in_order

KINDS = ("assign", "access", "hex")
SAMPLE = 6_000          # documents the field is fitted on, at most
WINDOWS = 40            # stretches of one document among them, at most
AROUND = 8              # words on each side of a word that is learned from
CUES = 64               # words before secrets that are told apart, at most
CACHED_WORDS = 500_000  # a worker's word table is emptied beyond this; it only saves repeated work
OUT, BEGIN, INSIDE = range(3)

# fixed values: the patterns of the base kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")       # AKIA[A-Z0-9]+ of 18 characters and more: its runs are maximal
HEX = re.compile(r"[0-9a-f]{16,}")              # likewise
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# bytes without which no text matches: a word of ASSIGN in small letters, a run of HEX shown as one letter
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
HEX_BYTES = bytes(ord("h") if chr(i) in "0123456789abcdef" else 0 for i in range(256))
QUOTES = "\"'`,;.()[]{}<>*$%&#|!"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Searches of bytes tell which patterns a text can hold; most texts hold none, and no pattern is run on them."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    out = []
    if any(word in low for word in ASSIGN_WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if b"AKIA" in raw:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    if b"h" * 16 in raw.translate(HEX_BYTES):
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves stand: of an assignment its value."""
    out = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    return out + [(m.start(), m.end()) for p in (ACCESS, HEX) for m in p.finditer(text)]


def shape(word: str) -> tuple[str, ...]:
    """What a word looks like, as names of features."""
    core = word.strip(QUOTES)
    n = len(core)
    size = "n" + str(next((i for i, top in enumerate((0, 3, 7, 11, 15, 23, 39)) if n <= top), 7))
    if core.isalpha():
        return size, "lower" if core.islower() else "upper" if core.isupper() else "title" if core[1:].islower() else "mixed"
    if not core:
        return ("sign", "sign " + word[:2] if word[:1] in "=:" else "sign other")
    letters = {c for c in core if c.isalpha()}
    digits = sum(c.isdigit() for c in core)
    kind = ("digits" if digits == n else "number" if digits and not letters
            else "hex" if digits and letters <= set("abcdef") and digits + sum(c in "abcdef" for c in core) == n
            else "alnum" if core.isalnum() else "code" if digits and re.fullmatch(r"[A-Za-z0-9+/_=-]+", core) else "signs")
    return (size, kind, f"{kind} {size}", "rich" if len(set(core)) * 2 >= min(n, 20) else "poor",
            "joined" if "=" in core or ":" in core else "whole", "quoted" if word[0] in "\"'`" else "bare")


class Field:
    """Weights by feature and their sums by distinct word. A place's score adds what its own word says, what the two
    words before and the next one say of it, and what the file says."""

    PLACES = 4          # own, previous, the one before that, next

    def __init__(self, cues: list[str], weights: dict[str, list[list[float]]], turns: list[list[float]]):
        self.cues = frozenset(cues)
        self.weights, self.turns = weights, np.array(turns)
        self.words: dict[str, int] = {}
        self.kinds: dict[tuple, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, self.PLACES, 3))

    def names(self, word: str) -> tuple[str, ...]:
        bare = word.strip(QUOTES).lower()
        return (*shape(word), "cue " + bare) if bare in self.cues else shape(word)

    def codes(self, words: list[str]) -> np.ndarray:
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        known = self.words
        for word in set(words).difference(known):
            names = self.names(word)
            if names not in self.kinds:
                self.kinds[names] = len(self.rows)
                self.rows.append(sum((np.array(self.weights[x]) for x in names if x in self.weights),
                                     np.zeros((self.PLACES, 3))))
            known[word] = self.kinds[names]
        if len(self.table) < len(self.rows):
            self.table = np.array(self.rows)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def scores(self, words: list[str]) -> np.ndarray:
        codes = self.codes(words)
        own = self.table[codes]
        out = own[:, 0].copy()
        out[1:] += own[:-1, 1]
        out[2:] += own[:-2, 2]
        out[:-1] += own[1:, 3]
        return out + sum((np.array(self.weights[x][0]) for x in file_names(words) if x in self.weights), np.zeros(3))

    def decode(self, words: list[str]) -> list[tuple[int, int]]:
        """Best labels of the whole text, as (first, last) words of secrets.

        Where "outside" leads by more than any two transitions can make up, the best path is outside; such places part
        the text, and only the short stretches between them are gone through.
        """
        if not words:
            return []
        scores = self.scores(words)
        swing = 2 * (self.turns.max() - self.turns.min())
        unsure = np.flatnonzero(scores[:, OUT] - scores[:, 1:].max(axis=1) <= swing)
        out = []
        at = 0
        while at < len(unsure):
            to = at
            while to + 1 < len(unsure) and unsure[to + 1] == unsure[to] + 1:
                to += 1
            lo, hi = int(unsure[at]), int(unsure[to])
            left, right = lo > 0, hi + 1 < len(words)
            labels = viterbi(scores[lo:hi + 1], self.turns, left, right)
            for i, label in enumerate(labels):
                if label == INSIDE and i and labels[i - 1] != OUT and out:
                    out[-1] = (out[-1][0], lo + i)
                elif label != OUT:
                    out.append((lo + i, lo + i))
            at = to + 1
        return out


def viterbi(scores: np.ndarray, turns: np.ndarray, left: bool, right: bool) -> list[int]:
    """Best labels of a stretch whose neighbours, where there are any, are outside."""
    best = scores[0] + (turns[OUT] if left else 0)
    back = []
    for row in scores[1:]:
        paths = best[:, None] + turns
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    if right:
        best = best + turns[:, OUT]
    labels = [int(best.argmax())]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def file_names(words: list[str]) -> tuple[str, ...]:
    """Features of the file: how much of it is assignments, and how long it is."""
    signs = sum(map(words.count, ("=", ":", "=>")))
    return ("file assigns" if signs * 50 >= len(words) else "file prose", "file long" if len(words) > 2_000 else "file short")


def labelled_windows(batches):
    """(doc_id, text) to stretches of words with labels from the base patterns, and the file's features."""
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            text = text or ""
            parts = secret_parts(text)
            places = [(m.start(), m.end()) for m in WORD.finditer(text)]
            words = [text[a:b] for a, b in places]
            labels = [OUT] * len(words)
            for a, b in sorted(parts):
                own = [i for i, (x, y) in enumerate(places) if x < b and a < y]
                for i in own:
                    labels[i] = INSIDE if i > own[0] else BEGIN
            telling = [i for i, w in enumerate(words) if labels[i] != OUT or not w.strip(QUOTES).isalpha()]
            telling = (telling + list(range(0, len(words), max(1, len(words) // 3))))[:WINDOWS]
            file = list(file_names(words))
            seen = -1
            for i in sorted(telling):
                if i > seen:
                    lo, hi = max(0, i - AROUND), min(len(words), i + AROUND + 1)
                    out.append((words[lo:hi], labels[lo:hi], file))
                    seen = hi - AROUND - 1
        words, labels, files = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.int32())),
                                          pa.array(files, pa.list_(pa.string()))], names=["words", "labels", "file"])


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit_field(rows: list[tuple[list[str], list[int], list[str]]], epochs: int = 80, pull: float = 1e-4) -> Field | None:
    """Most likely weights (forward-backward gradients, Adam) of stretches with labels; None without any secret."""
    if not any(any(labels) for _, labels, _ in rows):
        return None
    before: dict[str, int] = {}
    for words, labels, _ in rows:
        for i, label in enumerate(labels):
            if label == BEGIN:
                for j in (i - 1, i - 2):
                    if j >= 0 and words[j].strip(QUOTES).isalpha():
                        cue = words[j].strip(QUOTES).lower()
                        before[cue] = before.get(cue, 0) + 1
    cues = sorted((c for c in before if before[c] > 2), key=lambda c: (-before[c], c))[:CUES]
    field = Field(cues, {}, [[0.0] * 3] * 3)
    index: dict[str, int] = {}
    longest = max(len(w) for w, _, _ in rows)
    shapes: dict[tuple, int] = {}
    code = np.zeros((len(rows), longest), dtype=np.int64)
    truth = np.zeros((len(rows), longest), dtype=np.int64)
    inside = np.zeros((len(rows), longest), dtype=bool)
    files = np.zeros((len(rows), 0))
    for r, (words, labels, _) in enumerate(rows):
        for i, word in enumerate(words):
            names = field.names(word)
            for x in names:
                index.setdefault(x, len(index))
            code[r, i] = shapes.setdefault(names, len(shapes))
        truth[r, :len(labels)] = labels
        inside[r, :len(labels)] = True
    file_index = {x: i for i, x in enumerate(sorted({x for _, _, f in rows for x in f}))}
    files = np.array([[x in f for x in file_index] for _, _, f in rows], dtype=float)
    has = np.zeros((len(shapes), len(index)))
    for names, i in shapes.items():
        has[i, [index[x] for x in names]] = 1
    # distinct shapes stand for words: gradients are gathered by shape, then by feature
    w = {"w": np.zeros((len(index), Field.PLACES, 3)), "f": np.zeros((len(file_index), 3)), "t": np.zeros((3, 3))}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    n, T = code.shape
    shifts = ((0, 0), (1, 1), (2, 2), (3, -1))
    for epoch in range(1, epochs + 1):
        table = np.einsum("sf,fpl->spl", has, w["w"])
        e = np.zeros((n, T, 3))
        for place, by in shifts:
            own = np.where(inside[:, :, None], table[code, place], 0)
            if by >= 0:
                e[:, by:] += own[:, :T - by] if by else own
            else:
                e[:, :by] += own[:, -by:]
        e += (files @ w["f"])[:, None]
        e = np.where(inside[:, :, None], e, 0)
        forward, backward = np.zeros((n, T, 3)), np.zeros((n, T, 3))
        forward[:, 0] = e[:, 0]
        for t in range(1, T):
            step = log_sum(forward[:, t - 1][:, :, None] + w["t"], 1) + e[:, t]
            forward[:, t] = np.where(inside[:, t, None], step, forward[:, t - 1])
        for t in range(T - 2, -1, -1):
            step = log_sum(w["t"] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], step, 0)
        total = log_sum(forward[:, -1], 1)
        p = np.where(inside[:, :, None], np.exp(forward + backward - total[:, None, None]), 0)
        p[np.arange(n)[:, None], np.arange(T), truth] -= inside
        both = inside[:, 1:]
        pair = np.exp(forward[:, :-1, :, None] + w["t"] + (e + backward)[:, 1:, None, :] - total[:, None, None, None])
        slope_t = (pair * both[:, :, None, None]).sum(axis=(0, 1))
        np.add.at(slope_t, (truth[:, :-1][both], truth[:, 1:][both]), -1)
        by_shape = np.zeros((len(shapes), Field.PLACES, 3))
        for place, by in shifts:
            if by >= 0:
                source, own = p[:, by:] if by else p, code[:, :T - by] if by else code
            else:
                source, own = p[:, :by], code[:, -by:]
            for label in range(3):
                by_shape[:, place, label] = np.bincount(own.ravel(), source[:, :, label].ravel(), len(shapes))
        slope = {"w": np.einsum("sf,spl->fpl", has, by_shape), "f": files.T @ p.sum(axis=1), "t": slope_t}
        for k in w:
            g = slope[k] / n + pull * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            w[k] -= 0.15 * (m[k] / (1 - 0.9 ** epoch)) / (np.sqrt(v[k] / (1 - 0.99 ** epoch)) + 1e-8)
    weights = {x: w["w"][i].tolist() for x, i in index.items()}
    for x, i in file_index.items():
        weights[x] = [w["f"][i].tolist()] + [[0.0] * 3] * (Field.PLACES - 1)
    return Field(cues, weights, w["t"].tolist())


def sampled(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text) of at most ``size`` ids in the order of a hash of the id."""
    ids = (docs.where("doc_id is not null").select("doc_id").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def fit(docs: DataFrame) -> Field | None:
    rows = sampled(docs, SAMPLE).mapInArrow(
        labelled_windows, "words array<string>, labels array<int>, file array<string>").collect()
    # hash order of the words: the sample's order must not depend on how tasks end
    return fit_field(sorted((r.words, r.labels, r.file) for r in rows))


def finder(model: tuple | None):
    """Arrow function: (doc_id, text) to (doc_id, spans)."""
    kept: list[Field] = []          # made once in each worker

    def run(batches):
        if model and not kept:
            kept.append(Field(*model))
        field = kept[0] if kept else None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    added = []
                    if field:
                        words = WORD.findall(text)
                        hits = field.decode(words)
                        if hits:
                            places = [(m.start(), m.end()) for m in WORD.finditer(text)]
                            for a, b in hits:
                                begin, end = places[a][0], places[b][1]
                                lead = len(text[begin:end]) - len(text[begin:end].lstrip(QUOTES))
                                tail = len(text[begin:end]) - len(text[begin:end].rstrip(QUOTES))
                                if begin + lead < end - tail:
                                    added.append((begin + lead, end - tail, "field"))
                    found.append(in_order(base_spans(text), added, KINDS))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, ARROW)], names=["doc_id", "spans"])
    return run


def learned(docs: DataFrame) -> tuple | None:
    """The field's parameters for the workers, None without any secret to learn from."""
    field = fit(docs)
    return (sorted(field.cues), field.weights, field.turns.tolist()) if field else None


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row: what the base patterns find, and what the field adds, in code points.

    The field learns from base matches of a bounded sample and is decoded over every whole text; a sample without any
    secret leaves the base patterns alone. Null texts count as empty and have no spans; repeated rows are searched alike;
    an empty table gives an empty result; other columns are not looked at.
    """
    model = learned(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(finder(model), f"doc_id {kind}, {SPANS}")


MASK = "[SECRET]"


def masked(text: str | None, spans: list[dict]) -> str | None:
    """The text with every stretch that spans cover replaced by MASK."""
    if not text or not spans:
        return text
    out, last = [], 0
    whole: list[list[int]] = []
    for span in sorted(spans, key=lambda s: (s["begin"], s["end"])):
        if whole and span["begin"] < whole[-1][1]:
            whole[-1][1] = max(whole[-1][1], span["end"])
        else:
            whole.append([span["begin"], span["end"]])
    for begin, end in whole:
        out += [text[last:begin], MASK]
        last = end
    return "".join([*out, text[last:]])


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in its texts masked, and n_chars of the masked text."""
    find = finder(learned(docs))

    def run(batches):
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                texts = part.column(1)
                found = next(find(iter([pa.RecordBatch.from_arrays([texts, texts], names=["doc_id", "text"])])))
                out = [masked(t, s) for t, s in zip(texts.to_pylist(), found.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=["row", "text"])

    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    return with_text(rows.mapInArrow(run, f"row {kind}, text string"), docs.columns)


@query("op5_secret_field")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return find_secrets(documents(spark, sf)).select("doc_id", *digest_columns(KINDS))
