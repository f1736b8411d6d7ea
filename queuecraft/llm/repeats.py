"""Exact removal of repeated 100-byte strings by sparse enhanced suffix arrays over content-chosen anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import documents, starts_of, whole_groups, with_text, written
from queuecraft.llm.registry import query
from queuecraft.llm.shingles import mix

LENGTH = 100            # bytes of a string that counts as repeated
GRAM = 32               # bytes of an anchor; every string of LENGTH bytes holds LENGTH - GRAM + 1 candidates
GRAMS = LENGTH - GRAM + 1
CHUNK = 1 << 20         # bytes looked at together; longer texts go through in overlapping chunks
TOGETHER = 20_000       # contexts of one anchor that are sorted in one task; larger groups are compared string by string

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK + 2 * LENGTH)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def anchors(data: np.ndarray, allowed: np.ndarray):
    """Anchors of the strings that start at the ``allowed`` positions of ``data``.

    The anchor of a string is its 32-byte gram with the smallest number, the first of equal ones, so equal strings have
    equal anchors at equal places. Returns (anchor, first, last start that it owns, its number, number of the text from
    the first start to the end of the last string), in order of place.
    """
    n = len(data)
    if n < LENGTH or not allowed.any():
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    up, down = _powers(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(7)) * up[:n], out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
        least = (grams & ~np.uint64(0x1FFFFFF)) | np.arange(len(grams), dtype=np.uint64)   # place breaks ties
        span = 1
        while span * 2 <= GRAMS:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:len(least) - (GRAMS - span)], least[GRAMS - span:])
        starts = np.flatnonzero(allowed[:n - LENGTH + 1])
        chosen = (least[starts] & np.uint64(0x1FFFFFF)).astype(np.int64)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(new)
        first, anchor = starts[at], chosen[at]
        last = starts[np.append(at[1:], len(starts)) - 1]
        text = mix(mix((sums[last + LENGTH] - sums[first]) * down[first])
                   + ((anchor - first) * 256 + (last - first)).astype(np.uint64))
    return anchor, first, last, grams[anchor], text


def chunks(ids: list, texts: list):
    """Texts laid end to end in pieces of about CHUNK bytes: (bytes, ids by byte, places in their text, allowed starts)."""
    held, size = [], 0
    for doc_id, text in zip(ids, texts):
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        for at in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
            part = data[at:at + CHUNK + LENGTH - 1]
            held.append((doc_id, at, part))
            size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


ROW = "route long, kind int, gram long, text long, doc_id long, place long"
ALONE, SURE, MARK, COVERED = range(4)


def _pack(first, anchor, last):
    return first << 14 | (anchor - first) << 7 | (last - first)


def _unpack(place):
    first = place >> 14
    return first, first + (place >> 7 & 127), first + (place & 127)


def anchor_rows(batches):
    """(doc_id, text) to anchors, after what one task can settle by itself.

    Of equal texts around equal anchors only the first occurrence goes on; what the others own is COVERED. An anchor
    with several texts here is known to be shared: its rows are SURE and travel by their text, so that a passage in
    a third of all documents does not meet in one task, and a MARK tells the other tasks' rows of that anchor.
    """
    parts, covered, size = [], [], 0

    def flush():
        gram, text, doc_id, place = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((place, doc_id, text, gram))
        gram, text, doc_id, place = gram[order], text[order], doc_id[order], place[order]
        ends = starts_of(gram, text)
        lead = np.zeros(len(gram), dtype=bool)
        lead[ends[:-1]] = True
        same = np.zeros(len(gram), dtype=bool)           # a repeated row: the same place again, not an earlier one
        same[1:] = (doc_id[1:] == doc_id[:-1]) & (place[1:] == place[:-1]) & ~lead[1:]
        rest = ~lead & ~same
        first, _, last = _unpack(place[rest])
        covered.append(merged(doc_id[rest], first, last + LENGTH))
        gram, text, doc_id, place = gram[lead], text[lead], doc_id[lead], place[lead]
        ends = starts_of(gram)
        sure = np.repeat(np.diff(ends) > 1, np.diff(ends))
        marks = gram[ends[:-1]][np.diff(ends) > 1]
        c_id, c_from, c_to = (np.concatenate(x) for x in zip(*covered))
        zeros = lambda k: np.zeros(k, np.int64)
        columns = [
            np.concatenate([np.where(sure, text, gram), marks, c_id]),
            np.concatenate([np.where(sure, SURE, ALONE), np.full(len(marks), MARK), np.full(len(c_id), COVERED)]).astype(np.int32),
            np.concatenate([gram, marks, c_from]), np.concatenate([text, zeros(len(marks)), c_to]),
            np.concatenate([doc_id, zeros(len(marks)), c_id]), np.concatenate([place, zeros(len(marks)), zeros(len(c_id))])]
        parts.clear()
        covered.clear()
        table = pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                           names=["route", "kind", "gram", "text", "doc_id", "place"])
        for at in range(0, table.num_rows, 50_000):
            yield table.slice(at, 50_000)

    for batch in batches:
        for held in chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lengths = np.array([len(p) for _, _, p in held])
            ends = np.cumsum(lengths)
            begin = ends - lengths
            allowed = np.ones(ends[-1], dtype=bool)
            for e, b in zip(ends, begin):
                allowed[max(e - LENGTH + 1, b):e] = False
            anchor, first, last, gram, text = anchors(np.concatenate([p for _, _, p in held]), allowed)
            own = np.searchsorted(ends, first, side="right")
            shift = np.array([at for _, at, _ in held])[own] - begin[own]
            ids = np.array([i for i, _, _ in held], dtype=np.int64)[own]
            parts.append((gram.view(np.int64), text.view(np.int64), ids,
                          _pack(first + shift, anchor + shift, last + shift)))
            size += len(first)
            if size >= 1_000_000:
                yield from flush()
                size = 0
    if parts:
        yield from flush()


def merged(doc_id, begin, end):
    """Overlapping or touching stretches of one document put together; sorted by document and place."""
    if not len(doc_id):
        return doc_id, begin, end
    order = np.lexsort((begin, doc_id))
    doc_id, begin, end = doc_id[order], begin[order], end[order]
    edges = starts_of(doc_id)
    reach = end.copy()
    for lo, hi in zip(edges[:-1], edges[1:]):
        np.maximum.accumulate(end[lo:hi], out=reach[lo:hi])
    new = np.ones(len(doc_id), dtype=bool)
    new[1:] = (doc_id[1:] != doc_id[:-1]) | (begin[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return doc_id[at], begin[at], reach[np.append(at[1:], len(doc_id)) - 1]


def shared_anchors(batches):
    """Rows sorted by route: anchors met twice or more, SURE rows and COVERED stretches go on."""
    for frame in whole_groups(batches, ["route"]):
        alone = frame["kind"].eq(ALONE) & ~frame.duplicated("route", keep=False)
        yield pa.RecordBatch.from_pandas(frame[~alone & frame["kind"].ne(MARK)], preserve_index=False)


def first_texts(batches):
    """Rows sorted by text, anchor and place: first occurrences stay rows, what later ones own is COVERED."""
    for frame in whole_groups(batches, ["text", "gram"]):
        same = frame.duplicated(["text", "gram", "doc_id", "place"])
        lead = ~frame.duplicated(["text", "gram"])
        rest = frame[~lead & ~same]
        first, _, last = _unpack(rest["place"].to_numpy())
        c_id, c_from, c_to = merged(rest["doc_id"].to_numpy(), first, last + LENGTH)
        yield pa.RecordBatch.from_pandas(frame[lead], preserve_index=False)
        yield pa.RecordBatch.from_pydict({
            "route": c_id, "kind": np.full(len(c_id), COVERED, np.int32), "gram": c_from, "text": c_to, "doc_id": c_id,
            "place": np.zeros(len(c_id), np.int64)})


def context_bytes(batches):
    """(doc_id, text, spots: array of (gram, place)) to (gram, doc_id, place, around: bytes of all owned strings)."""
    for batch in batches:
        rows = []
        for doc_id, text, spots in zip(*(c.to_pylist() for c in batch.columns)):
            data = (text or "").encode("utf-8", "surrogatepass")
            for spot in spots:
                first, _, last = _unpack(spot["place"])
                rows.append((spot["gram"], doc_id, spot["place"], data[first:last + LENGTH]))
        for at in range(0, len(rows), 20_000):
            gram, ids, place, around = zip(*rows[at:at + 20_000])
            yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int64()), pa.array(ids, pa.int64()),
                                              pa.array(place, pa.int64()), pa.array(around, pa.binary())],
                                             names=["gram", "doc_id", "place", "around"])


def _suffix_array(gram: np.ndarray, sides: np.ndarray, lengths: np.ndarray):
    """Order of the rows by (gram, bytes), and the common prefix of each with the one before it (-1 across grams)."""
    width = sides.shape[1]
    keyed = np.empty((len(gram), 8 + width), dtype=np.uint8)
    keyed[:, :8] = gram.astype(">i8").view(np.uint8).reshape(-1, 8)
    keyed[:, 8:] = sides
    order = np.argsort(keyed.view(f"S{8 + width}").ravel(), kind="stable")
    sides, lengths, gram = sides[order], lengths[order], gram[order]
    common = np.full(len(gram), -1, dtype=np.int64)
    differ = sides[1:] != sides[:-1]
    alike = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[1:] = np.where(gram[1:] == gram[:-1], np.minimum(alike, np.minimum(lengths[1:], lengths[:-1])), -1)
    return order, common


def repeated_starts(gram, doc_id, place, around):
    """For contexts of shared anchors: (row, back) of every owned string, ``back`` bytes before the anchor, that an
    earlier context holds as well.

    Two enhanced suffix arrays, one of what stands from the anchor on and one, mirrored, of what stands before it. A
    string that reaches ``back`` bytes before its anchor has LENGTH - back bytes behind: at that depth the rows' common-
    prefix intervals are the runs of the first array, and the rows with equal left extensions the runs of the second.
    Rows in one run of both hold the same string, and each interval's occurrences but the earliest repeat it. Runs of
    one row end the test early, so a depth costs only what still has company.
    """
    m = len(gram)
    first, anchor, last = _unpack(place)
    before, near = anchor - first, anchor - last
    right = np.zeros((m, LENGTH), dtype=np.uint8)
    left = np.zeros((m, GRAMS), dtype=np.uint8)
    sizes = np.array([len(x) for x in around], dtype=np.int64)
    for i, data in enumerate(around):            # one more than the byte: no text holds 255, and 0 is no text
        own = np.frombuffer(data, dtype=np.uint8) + np.uint8(1)
        b = before[i]
        right[i, :len(own) - b] = own[b:b + LENGTH]
        left[i, :b] = own[:b][::-1]
    r_order, r_common = _suffix_array(gram, right, sizes - before)
    l_order, l_common = _suffix_array(gram, left, before)
    rank = np.empty(m, dtype=np.int64)
    rank[np.lexsort((anchor, doc_id))] = np.arange(m)
    rows_out, back_out = [], []
    r_run, l_run = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    for back in range(GRAMS):
        joined = r_common >= LENGTH - back
        company = joined.copy()
        company[:-1] |= joined[1:]
        if not company.any():
            continue
        rows = r_order[company]
        rows = rows[(near[rows] <= back) & (back <= before[rows])]
        if len(rows) < 2:
            continue
        r_run[r_order] = np.cumsum(~joined)
        l_run[l_order] = np.cumsum(l_common < back)
        rows = rows[np.lexsort((rank[rows], l_run[rows], r_run[rows]))]
        a, b = r_run[rows], l_run[rows]
        later = np.zeros(len(rows), dtype=bool)
        later[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        rows_out.append(rows[later])
        back_out.append(np.full(int(later.sum()), back))
    none = np.zeros(0, np.int64)
    return (np.concatenate(rows_out), np.concatenate(back_out)) if rows_out else (none, none)


def repeated_stretches(batches):
    """Contexts sorted by anchor to covered stretches (doc_id, begin, end)."""
    for frame in whole_groups(batches, ["gram"]):
        doc_id, place = frame["doc_id"].to_numpy(), frame["place"].to_numpy()
        rows, back = repeated_starts(frame["gram"].to_numpy(), doc_id, place, frame["around"].tolist())
        start = _unpack(place[rows])[1] - back
        yield pa.RecordBatch.from_pydict(dict(zip(("doc_id", "begin", "end"), merged(doc_id[rows], start, start + LENGTH))))


def single_strings(batches):
    """Contexts to their owned strings: (string: 16 bytes of its SHA-256, doc_id, start)."""
    for batch in batches:
        rows = []
        for doc_id, place, around in zip(*(c.to_pylist() for c in batch.columns)):
            first, _, last = _unpack(place)
            rows += [(hashlib.sha256(around[i:i + LENGTH]).digest()[:16], doc_id, first + i) for i in range(last - first + 1)]
        for at in range(0, len(rows), 50_000):
            string, ids, start = zip(*rows[at:at + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(string, pa.binary()), pa.array(ids, pa.int64()),
                                              pa.array(start, pa.int64())], names=["string", "doc_id", "start"])


def digest() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("_digest")


def places(docs: DataFrame) -> DataFrame:
    """(doc_id, _digest, _id) of every distinct pair: _id rises with doc_id, nulls last, then with the text's digest."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("_digest")]
    return written(docs.select("doc_id", digest()).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_id", F.monotonically_increasing_id()))


def same_text(rows: DataFrame, keyed: DataFrame, how: str) -> DataFrame:
    """``rows`` (doc_id, _digest, ...) joined with ``keyed`` on both; null ids are equal."""
    keyed = keyed.withColumnsRenamed({"doc_id": "_doc", "_digest": "_text"})
    return rows.join(keyed, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_digest") == F.col("_text")), how)


def with_spans(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` (doc_id, _digest, ...) with the stretches of ``docs`` to remove from each text as ``spans``."""
    keys = places(docs)
    spans = removed_spans(docs, keys).groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_set(F.struct("begin", "end")).alias("spans"))
    return same_text(rows, keys.join(spans, "_id").select("doc_id", "_digest", "spans"), "left")


def removed_spans(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id: the _id in ``keys``, begin, end) stretches of UTF-8 bytes to remove; several per document, which may touch or overlap.

    1. Every 100-byte string has an anchor; a task sends each (anchor, text around it) once. 2. Anchors met once go.
    3. Equal texts around an anchor: all strings of all but the first occurrence repeat. 4. Different texts around one
    anchor are compared by suffix arrays per anchor; anchors with more than TOGETHER texts string by string, with a
    combine before the shuffle. Both ways find the same. Texts around anchors are told apart by 128 bits.
    """
    texts = written(same_text(docs.where(F.octet_length("text") >= LENGTH).select("doc_id", "text", digest()), keys, "inner")
                    .select(F.col("_id").alias("doc_id"), "text"))
    met = written(texts.mapInArrow(anchor_rows, ROW).repartition("route").sortWithinPartitions("route")
                  .mapInArrow(shared_anchors, ROW))
    leads = written(met.where(F.col("kind") != COVERED).repartition("text").sortWithinPartitions("text", "gram", "doc_id", "place")
                    .mapInArrow(first_texts, ROW))
    stretch = [F.col("doc_id"), F.col("gram").alias("begin"), F.col("text").alias("end")]
    covered = met.where(F.col("kind") == COVERED).select(*stretch).union(
        leads.where(F.col("kind") == COVERED).select(*stretch))
    leads = leads.where(F.col("kind") != COVERED).select("gram", "doc_id", "place")
    several = leads.groupBy("gram").agg(F.count("*").alias("texts")).where("texts > 1")
    spots = (leads.join(several, "gram").groupBy("doc_id")
             .agg(F.collect_list(F.struct("gram", "place")).alias("spots")))
    around = written(texts.join(spots, "doc_id").select("doc_id", "text", "spots")
                     .mapInArrow(context_bytes, "gram long, doc_id long, place long, around binary")
                     .dropDuplicates(["gram", "doc_id", "place"]))
    sizes = around.groupBy("gram").agg(F.count("*").alias("texts"))
    large = sizes.where(F.col("texts") > TOGETHER).select("gram")
    found = (around.join(large, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
             .mapInArrow(repeated_stretches, "doc_id long, begin long, end long"))
    strings = written(around.join(large, "gram", "left_semi").select("doc_id", "place", "around")
                      .mapInArrow(single_strings, "string binary, doc_id long, start long"))
    earliest = strings.groupBy("string").agg(F.min(F.struct("doc_id", "start")).alias("e"), F.count("*").alias("n")).where("n > 1")
    again = (strings.join(earliest, "string").where("struct(doc_id, start) > e")
             .select("doc_id", F.col("start").alias("begin"), (F.col("start") + LENGTH).alias("end")))
    return written(covered.union(found).union(again))


def cut_out(batches):
    """(doc_id, text, spans: array of (begin, end)) to (doc_id, n_bytes, spans merged, kept: bytes)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            out = []
            for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                data = (text or "").encode("utf-8", "surrogatepass")
                whole = []
                for begin, end in sorted((s["begin"], min(s["end"], len(data))) for s in spans or []):
                    if whole and begin <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], end)
                    elif begin < end:
                        whole.append([begin, end])
                kept, last = [], 0
                for begin, end in whole:
                    kept.append(data[last:begin])
                    last = end
                kept.append(data[last:])
                out.append((doc_id, len(data), [{"begin": b, "end": e} for b, e in whole], b"".join(kept)))
            doc_id, n, whole, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id, batch.column(0).type), pa.array(n, pa.int64()),
                 pa.array(whole, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept: bytes) of every row: its text without each byte that a string of 100 bytes
    covers which also starts earlier, in a smaller doc_id or before it in the same document.

    Null and empty texts have no bytes. Rows that share doc_id and text are one document to the order: a place never
    repeats itself. Unlike texts of one doc_id follow each other in the order of a digest; texts without an id come last,
    likewise. Strings are judged on the input. An empty table gives an empty result; other columns are not looked at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (with_spans(docs.select("doc_id", "text", digest()), docs).select("doc_id", "text", "spans")
            .mapInArrow(cut_out, f"doc_id {kind}, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"))


def whole_characters(batches):
    """(row, text, spans) to (row, text without the spans); a character goes only if all of its bytes do."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                data, kept, last = (text or "").encode("utf-8", "surrogatepass"), [], 0
                whole: list[list[int]] = []
                for begin, end in sorted((s["begin"], min(s["end"], len(data))) for s in spans or []):
                    if whole and begin <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], end)
                    else:
                        whole.append([begin, end])
                for begin, end in whole:
                    while begin < end and data[begin] & 0xC0 == 0x80:
                        begin += 1
                    while end > begin and end < len(data) and data[end] & 0xC0 == 0x80:
                        end -= 1
                    kept.append(data[last:begin])
                    last = end
                kept.append(data[last:])
                out.append(text if text is None else b"".join(kept).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=["row", "text"])


def without_repeated_text(docs: DataFrame) -> DataFrame:
    """``docs`` with each text, and its n_chars, as ``without_repeats`` leaves it, in whole characters."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]     # the text travels once
    rows = docs.select(F.struct(*others).alias("row"), "doc_id", "text", digest())
    joined = with_spans(rows, docs.select("doc_id", "text")).select("row", "text", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    return with_text(joined.mapInArrow(whole_characters, f"row {kind}, text string"), docs.columns)


@query("op9_common_prefix_intervals")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    out = without_repeats(documents(spark, sf))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
