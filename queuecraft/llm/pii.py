"""Personal data in texts: fixed patterns, and a character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from queuecraft.llm.common import documents
from queuecraft.llm.registry import query
from queuecraft.llm.secrets import log_sum, sampled
from queuecraft.llm.spans import ARROW, SPANS, digest_columns, in_order

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 6_000          # documents the network is trained on, at most
WINDOWS = 20            # stretches of one document among them, at most
STEPS = 240             # batches of training
HIDDEN = 16
WINDOW, STRIDE = 128, 64
CONTEXT = 24            # characters on each side of a digit or an @ in a stretch the network is trained on
TAGS = 1 + 2 * len(KINDS)       # outside; begin and inside of each kind

# fixed values: the patterns of the base kinds. A match of four numbers can only begin where a run of digits does
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Every kind holds a digit or an @, so a stretch without either has nothing to tag.
TELLING = re.compile("[0-9@]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: a name as long as it reaches, then a domain."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return out


def luhn(digits: list[int]) -> bool:
    own = digits[::-1]
    return (sum(own[::2]) + sum(d * 2 - 9 * (d > 4) for d in own[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(a, b, "email") for a, b in emails(text)]
    if TELLING.search(text):
        out += [(m.start(), m.end(), "ip") for m in IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = [ord(c) - 48 for c in m[0] if c not in " -"]
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text)
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around every digit and @, apart from each other."""
    out: list[list[int]] = []
    for m in TELLING.finditer(text):
        begin, end = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and begin <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


#: Letters by case and script and digits are told apart, marks one by one.
VOCABULARY = 128 + 4


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return np.where(codes < 128, codes, np.where(codes < 0x250, 128, np.where(codes < 0x2000, 129, 130)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def lstm(codes: np.ndarray, p: dict[str, np.ndarray], side: str, keep: bool):
    """Hidden states (batch, time, HIDDEN) of one direction; with ``keep`` also what the gradient needs."""
    n, T = codes.shape
    H = HIDDEN
    x = p["x" + side][codes]
    h, c = np.zeros((n, H), np.float32), np.zeros((n, H), np.float32)
    out, kept = np.zeros((n, T, H), np.float32), []
    for t in (range(T) if side == "f" else range(T - 1, -1, -1)):
        z = x[:, t] + h @ p["h" + side]
        gates, g = sigmoid(z[:, :3 * H]), np.tanh(z[:, 3 * H:])
        i, f, o = gates[:, :H], gates[:, H:2 * H], gates[:, 2 * H:]
        c_new = f * c + i * g
        th = np.tanh(c_new)
        h_new = o * th
        if keep:
            kept.append((t, i, f, o, g, c, th, h))
        h, c = h_new, c_new
        out[:, t] = h
    return out, kept


def lstm_slope(codes, p, side, kept, d_out, slope) -> None:
    n, H = len(codes), HIDDEN
    dh, dc = np.zeros((n, H), np.float32), np.zeros((n, H), np.float32)
    for t, i, f, o, g, c, th, h in reversed(kept):
        dh = dh + d_out[:, t]
        dc = dc + dh * o * (1 - th * th)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        np.add.at(slope["x" + side], codes[:, t], dz)
        slope["h" + side] += h.T @ dz
        dh, dc = dz @ p["h" + side].T, dc * f


def emissions(codes: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """Tag scores (batch, time, TAGS) of windows. Both directions go side by side and a window is a column, so that every
    step works on whole contiguous blocks; a sigmoid is a tanh of half its argument, so one tanh serves all gates."""
    n, T = codes.shape
    H = HIDDEN
    half = np.where(np.arange(4 * H) < 3 * H, np.float32(0.5), np.float32(1))
    tables = [p["x" + side] * half for side in "fb"]
    turns = np.stack([(p["h" + side] * half).T for side in "fb"])
    tags = np.stack([p["out"][:H].T, p["out"][H:].T])
    at = np.ascontiguousarray(codes.T)
    h, c = np.zeros((2, H, n), np.float32), np.zeros((2, H, n), np.float32)
    z, new = np.empty((2, 4 * H, n), np.float32), np.empty((2, H, n), np.float32)
    out = np.zeros((T, TAGS, n), np.float32)
    for t in range(T):
        np.matmul(turns, h, out=z)
        z[0] += tables[0][at[t]].T
        z[1] += tables[1][at[T - 1 - t]].T
        np.tanh(z, out=z)
        gates = z[:, :3 * H]
        gates *= np.float32(0.5)
        gates += np.float32(0.5)
        np.multiply(z[:, :H], z[:, 3 * H:], out=new)
        c *= z[:, H:2 * H]
        c += new
        np.tanh(c, out=new)
        np.multiply(z[:, 2 * H:3 * H], new, out=h)
        e = tags @ h
        out[t] += e[0]
        out[T - 1 - t] += e[1]
    return out.transpose(2, 0, 1) + p["bias"]


def train(texts: list[tuple[str, list[int]]], steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray] | None:
    """Network from stretches of text with a tag per character; None without any tagged character."""
    if not any(any(tags) for _, tags in texts):
        return None
    rng = np.random.default_rng(seed)
    H, scale = HIDDEN, 0.2
    p = {"out": rng.normal(0, scale, (2 * H, TAGS)), "bias": np.zeros(TAGS), "turns": np.zeros((TAGS, TAGS))}
    for side in "fb":
        p["x" + side] = rng.normal(0, scale, (VOCABULARY, 4 * H))
        p["x" + side][:, H:2 * H] += 1          # remember at first
        p["h" + side] = rng.normal(0, scale, (H, 4 * H))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    told = [i for i, (_, tags) in enumerate(texts) if any(tags)]
    plain = [i for i, (_, tags) in enumerate(texts) if not any(tags)] or told
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(told, 40), rng.choice(plain, 24)])
        T = max(len(texts[i][0]) for i in chosen)
        n = len(chosen)
        codes = np.full((n, T), VOCABULARY - 1, dtype=np.int64)
        truth, inside = np.zeros((n, T), dtype=np.int64), np.zeros((n, T), dtype=bool)
        for r, i in enumerate(chosen):
            text, tags = texts[i]
            codes[r, :len(tags)] = symbols(text)
            truth[r, :len(tags)] = tags
            inside[r, :len(tags)] = True
        hf, kf = lstm(codes, p, "f", True)
        hb, kb = lstm(codes, p, "b", True)
        both = np.concatenate([hf, hb], axis=2)
        e = np.where(inside[:, :, None], both @ p["out"] + p["bias"], 0).astype(np.float64)
        turns = p["turns"].astype(np.float64)
        forward, backward = np.zeros((n, T, TAGS)), np.zeros((n, T, TAGS))
        forward[:, 0] = e[:, 0]
        for t in range(1, T):
            forward[:, t] = np.where(inside[:, t, None], log_sum(forward[:, t - 1][:, :, None] + turns, 1) + e[:, t], forward[:, t - 1])
        for t in range(T - 2, -1, -1):
            backward[:, t] = np.where(inside[:, t + 1, None], log_sum(turns + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2), 0)
        total = log_sum(forward[:, -1], 1)
        de = np.where(inside[:, :, None], np.exp(forward + backward - total[:, None, None]), 0)
        de[np.arange(n)[:, None], np.arange(T), truth] -= inside
        pair = np.exp(forward[:, :-1, :, None] + turns + (e + backward)[:, 1:, None, :] - total[:, None, None, None])
        d_turns = (pair * inside[:, 1:, None, None]).sum(axis=(0, 1))
        np.add.at(d_turns, (truth[:, :-1][inside[:, 1:]], truth[:, 1:][inside[:, 1:]]), -1)
        de = (de / n).astype(np.float32)
        slope = {k: np.zeros_like(x) for k, x in p.items()}
        slope["out"] = both.reshape(-1, 2 * H).T @ de.reshape(-1, TAGS)
        slope["bias"], slope["turns"] = de.sum(axis=(0, 1)), (d_turns / n).astype(np.float32)
        d_both = de @ p["out"].T
        lstm_slope(codes, p, "f", kf, d_both[:, :, :H], slope)
        lstm_slope(codes, p, "b", kb, d_both[:, :, H:], slope)
        norm = float(np.sqrt(sum((g * g).sum() for g in slope.values())))
        rate = 0.02 * (1 - step / (steps + 1)) + 0.001
        for k in p:
            g = slope[k] * min(1.0, 5.0 / (norm + 1e-9)) + 1e-4 * p[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = p[k] - np.float32(rate) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in p.items()}


class Reading:
    """Tag scores of one text: overlapping windows are read each by itself, and where they overlap their scores are
    averaged, the more by a window the further the place is from its edges."""

    def __init__(self, text: str):
        self.codes = symbols(text)
        n = len(self.codes)
        self.sums, self.shares = np.zeros((n, TAGS)), np.zeros(n)
        self.seen = np.zeros(max(1, -(-(n - WINDOW + STRIDE) // STRIDE)) if n else 0, dtype=bool)      # by window

    def scores(self, begin: int, end: int) -> np.ndarray:
        return self.sums[begin:end] / self.shares[begin:end, None]

    def whole(self) -> np.ndarray:
        """Places all of whose windows were read."""
        blocks = np.append(self.seen, True) & np.append(True, self.seen)
        return np.repeat(blocks, STRIDE)[:len(self.codes)] if len(self.seen) > 1 else np.repeat(self.seen, len(self.codes))

    def windows_of(self, places: np.ndarray) -> np.ndarray:
        """The windows not yet read over the given places."""
        blocks = np.unique(places // STRIDE)
        wanted = np.unique(np.concatenate([blocks - 1, blocks]).clip(0, len(self.seen) - 1))
        return wanted[~self.seen[wanted]]


def read_windows(readings: list[Reading], windows: list[tuple[int, int]], p: dict[str, np.ndarray]) -> None:
    """Run the network over windows (reading, number). Each is filled up to the same length: the backward direction meets
    the filling first, so a window's scores must not depend on those it is read with."""
    for lo in range(0, len(windows), 512):
        part = windows[lo:lo + 512]
        sizes = [min(WINDOW, len(readings[i].codes) - w * STRIDE) for i, w in part]
        block = np.full((len(part), WINDOW), VOCABULARY - 1, dtype=np.int64)
        for r, ((i, w), n) in enumerate(zip(part, sizes)):
            block[r, :n] = readings[i].codes[w * STRIDE:w * STRIDE + n]
        e = emissions(block, p)
        for r, ((i, w), n) in enumerate(zip(part, sizes)):
            share, at = np.minimum(np.arange(1, n + 1), np.arange(n, 0, -1)), slice(w * STRIDE, w * STRIDE + n)
            readings[i].sums[at] += e[r, :n] * share[:, None]
            readings[i].shares[at] += share
            readings[i].seen[w] = True


def reconciled(texts: list[str], p: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Tag scores of every place of each text."""
    readings = [Reading(t) for t in texts]
    read_windows(readings, [(i, w) for i, r in enumerate(readings) for w in range(len(r.seen))], p)
    return [r.scores(0, len(r.codes)) for r in readings]


def surely_outside(scores: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Places outside any span on the best path, whatever stands beside them: "outside" leads each other tag by more than
    the two turns next to that tag can make up for."""
    before = np.maximum(0, (turns - turns[:, :1]).max(axis=0))
    after = np.maximum(0, (turns - turns[:1]).max(axis=1))
    return (scores[:, :1] - scores[:, 1:] > (before + after)[1:] + 1e-6).all(axis=1)


def decided(texts: list[str], p: dict[str, np.ndarray]) -> list[list[tuple[int, int, np.ndarray]]]:
    """Per text the stretches (begin, end, tags) of the whole text's best path that hold its digits and @, each from one
    place surely outside to the next or to an edge of the text.

    A span holds a digit or an @, and no span reaches across a place that is surely outside. So the windows over those
    characters are read first, and from each of them reading goes on both ways, as far as it takes, until such a place
    is met: what is found is what reading every window and one pass over the whole text would find.
    """
    turns = p["turns"].astype(np.float64)
    readings = [Reading(t) for t in texts]
    telling = [np.array([m.start() for m in TELLING.finditer(t)], dtype=np.int64) for t in texts]
    wanted = {i: at for i, at in enumerate(telling) if len(at)}
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    while wanted:
        read_windows(readings, [(i, int(w)) for i, at in wanted.items() for w in readings[i].windows_of(at)], p)
        going, wanted = wanted, {}
        for i in going:
            r, at = readings[i], telling[i]
            n, known = len(r.codes), r.whole()
            out = np.zeros(n, dtype=bool)
            out[known] = surely_outside(r.sums[known] / r.shares[known, None], turns)
            place = np.arange(n)
            # the nearest place on either side that is surely outside or not yet read whole
            stop = out | ~known
            left = np.maximum.accumulate(np.where(stop, place, -1))[at]
            right = np.minimum.accumulate(np.where(stop, place, n)[::-1])[::-1][at]
            ends = np.unique(np.concatenate([left[left >= 0], right[right < n]]))
            unread = ends[~known[ends]]
            if len(unread):
                wanted[i] = unread
            else:
                bounds[i] = np.maximum(left, 0), np.minimum(right + 1, n)
    stretches = []
    for i, (left, right) in bounds.items():
        new = np.append(True, left[1:] >= right[:-1])
        stretches += [(i, int(a), int(b)) for a, b in zip(left[new], right[np.append(new[1:], True)])]
    out: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in texts]
    for (i, a, b), tags in zip(stretches, best_tags([readings[i].scores(a, b) for i, a, b in stretches], turns)):
        out[i].append((a, b, tags))
    return out


def best_tags(scores: list[np.ndarray], turns: np.ndarray) -> list[np.ndarray]:
    """Best tags of every stretch as one whole; stretches of like length are gone through together."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    for lo in range(0, len(order), 256):
        group = order[lo:lo + 256]
        sizes = np.array([len(scores[i]) for i in group])
        if len(group) > 1 and sizes[-1] * len(group) > 4 * sizes.sum():       # unlike lengths: in halves
            for half in (group[:len(group) // 2], group[len(group) // 2:]):
                for i, own in zip(half, best_tags([scores[i] for i in half], turns)):
                    out[i] = own
            continue
        T, n = int(sizes[-1]), len(group)
        best = np.zeros((T, TAGS, n))           # best score of a path to each tag; a stretch that has ended keeps its own
        for r, i in enumerate(group):
            best[:sizes[r], :, r] = scores[i]
        for t, gone in enumerate(np.searchsorted(sizes, np.arange(1, T), side="right").tolist(), 1):
            best[t, :, :gone] = best[t - 1, :, :gone]
            best[t, :, gone:] += (best[t - 1, :, None, gone:] + turns[:, :, None]).max(axis=0)
        tags = np.zeros((n, T), dtype=np.int64)
        tags[:, -1] = best[-1].argmax(axis=0)
        for t in range(T - 1, 0, -1):
            own = tags[:, t]
            before = (best[t - 1] + turns[:, own]).argmax(axis=0)
            tags[:, t - 1] = np.where(t < sizes, before, own)
        for r, i in enumerate(group):
            out[i] = tags[r, :sizes[r]]
    return out


def tagged_spans(text: str, tags: np.ndarray) -> list[tuple[int, int, str]]:
    """Runs of one kind, without blanks at their ends; a run needs a digit or an @ and six characters, and must not cut
    through a word or number."""
    out, last = [], 0
    for at in np.flatnonzero(tags).tolist():
        if at < last:
            continue
        kind, end = (tags[at] - 1) // 2, at + 1
        while end < len(tags) and tags[end] == 2 * kind + 2:
            end += 1
        own = text[at:end]
        begin, stop = at + len(own) - len(own.lstrip()), end - len(own) + len(own.rstrip())
        cuts = text[begin - 1:begin].isalnum() or text[stop:stop + 1].isalnum()
        if stop - begin >= 6 and not cuts and TELLING.search(text, begin, stop):
            out.append((begin, stop, KINDS[kind]))
        last = end
    return out


def labelled_stretches(batches):
    """(doc_id, text) to stretches with a tag per character from the base patterns."""
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            text = text or ""
            tags = [0] * len(text)
            for begin, end, kind in sorted(base_spans(text), reverse=True):
                k = KINDS.index(kind)
                tags[begin:end] = [2 * k + 1] + [2 * k + 2] * (end - begin - 1)
            near = [(max(a, b - WINDOW), b) for a, b in regions(text)]
            apart = [(a, min(a + WINDOW, len(text))) for a in range(0, len(text), max(WINDOW, len(text) // 2 + 1))]
            out += [(text[a:b], tags[a:b]) for a, b in (near + apart)[:WINDOWS] if b > a]
        texts, tags = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(tags, pa.list_(pa.int32()))],
                                         names=["text", "tags"])


def groups(texts: list[str], size: int = 1 << 18) -> list[list[int]]:
    """Places of the texts that hold anything, those of like length together, about ``size`` characters a group."""
    out: list[list[int]] = []
    room = 0
    for i in sorted((i for i, t in enumerate(texts) if t), key=lambda i: len(texts[i])):
        if not out or len(texts[i]) > room:
            out.append([])
            room = size
        out[-1].append(i)
        room -= len(texts[i])
    return out


def finder(model: dict[str, np.ndarray] | None):
    """Arrow function: (doc_id, text) to (doc_id, spans)."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [t or "" for t in part.column(1).to_pylist()]
                added: list[list[tuple[int, int, str]]] = [[] for _ in texts]
                if model:
                    # about a quarter of a million characters at once, whole texts each: that bounds the memory of a task
                    for group in groups(texts):
                        for i, found in zip(group, decided([texts[i] for i in group], model)):
                            added[i] = [(a + x, a + y, kind) for a, b, tags in found for x, y, kind in tagged_spans(texts[i][a:b], tags)]
                found = [in_order(base_spans(t), more, KINDS) for t, more in zip(texts, added)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, ARROW)], names=["doc_id", "spans"])
    return run


def fit(docs: DataFrame) -> dict[str, np.ndarray] | None:
    rows = sampled(docs, SAMPLE).mapInArrow(labelled_stretches, "text string, tags array<int>").collect()
    return train(sorted((r.text, r.tags) for r in rows))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row: what the base patterns find, and what the network adds, in code points.

    The network is trained on base spans of a bounded sample. Every whole text gets the spans of its best path, as if all
    its overlapping windows were read and their scores put together (see ``decided``). A sample without any span leaves the base
    patterns alone. Null texts count as empty and have no spans; repeated rows are searched alike; an empty table gives
    an empty result; other columns are not looked at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(finder(fit(docs)), f"doc_id {kind}, {SPANS}")


@query("op7_character_network")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return find_personal_data(documents(spark, sf)).select("doc_id", *digest_columns(KINDS))
