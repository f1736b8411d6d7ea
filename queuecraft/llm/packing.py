"""Packing of tokenised documents into fixed-length sequences by harmonic classes."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuecraft.llm.common import documents, numbered, written
from queuecraft.llm.registry import query

CAPACITY = 4096
END_ID = 2
TOLERANCE = 64          # a piece may leave 1/64 of its slot empty before it is cut
CACHED_WORDS = 800_000  # a worker's word table is emptied beyond this; it only saves repeated work
MARKS = ".,*$%&#!?;:"    # marks that end words; none begins or ends a special token or a contraction
TOKENIZER = "word_bpe_49k.json"


def cuts(length: int, capacity: int = CAPACITY, tolerance: int = TOLERANCE) -> list[tuple[int, int]]:
    """Cut a document into (piece length, class); class k holds k pieces of at most capacity // k each.

    Whole sequences come first. A rest that fills its slot but for 1/tolerance stays whole; else the largest exact
    slot is cut off it.
    """
    out = [(capacity, 1)] * (length // capacity)
    left = length % capacity
    while left:
        k = capacity // left
        slot = capacity // k
        if slot - left <= slot // tolerance:
            out.append((left, k))
            break
        k += 1
        slot = capacity // k
        out.append((slot, k))
        left -= slot
    return out


class WordIds(dict):
    """Ids of white-space-separated words as little-endian bytes, each distinct word tokenised when first asked for.

    The tokeniser drops white space between words and never looks across it. It also never joins a letter or digit
    with the marks behind it, so ``word,`` is put together from ``word`` and the comma. A word of lower-case Latin-1 letters
    is one piece to the tokeniser's splitter and unchanged by its normaliser, so it goes to the merges at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        letters = [chr(c) for c in range(256) if chr(c).isalpha() and chr(c).islower()]
        self.letters = frozenset(letters)
        self.ends = self.letters.union("0123456789")
        self.as_bytes = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        bare = word.rstrip(MARKS)
        if bare != word and bare and bare[-1] in self.ends:
            ids = self[bare] + self[word[len(bare):]]
        elif word and self.letters.issuperset(word):
            ids = array("I", [t.id for t in self.merges.tokenize(word.translate(self.as_bytes))]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids


_TABLES: dict[str, WordIds] = {}      # a worker keeps its table from task to task


def words_of(text: str | None) -> list[str]:
    text = text or ""
    try:
        text.encode("latin-1")
        text = text.lower()           # the tokeniser lowers too; within Latin-1 in the same way
    except UnicodeEncodeError:
        pass
    return text.replace("\n", " ").replace("\t", " ").split(" ")


def token_pieces(path: str, capacity: int, tolerance: int):
    """Arrow function: documents to pieces, documents being put together from their words' ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _TABLES:
            _TABLES[path] = WordIds(path)
        ids_of = _TABLES[path]
        table: dict[int, list[tuple[int, int]]] = {}
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, words = part.column(0).to_pylist(), [words_of(t) for t in part.column(1).to_pylist()]
                rows = []
                for doc_id, own in zip(ids, words):
                    data = memoryview(b"".join(map(ids_of.__getitem__, own)) + end)
                    n, start = len(data) // 4, 0
                    if n not in table:
                        table[n] = cuts(n, capacity, tolerance)
                    for length, k in table[n]:
                        rows.append((doc_id, start, length, zlib.crc32(data[4 * start:4 * (start + length)]), n, k))
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k"])
    return run


def fill_rest(capacity: int):
    """Pieces that fill no whole bin of their class (fewer than k of class k, a constant bound): longest first, each
    into the first bin with room."""
    def run(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], na_position="first")
        room, bins, offsets, opened = [], [], [], 0
        for length in rest["length"]:
            at = opened
            while at < len(room) and room[at] < length:
                at += 1
            if at == len(room):
                room.append(capacity)
            bins.append(at)
            offsets.append(capacity - room[at])
            room[at] -= length
            while opened < len(room) and room[opened] == 0:
                opened += 1
        return rest.assign(bin=bins, offset=offsets)
    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, tolerance: int = TOLERANCE) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of sequences of ``capacity`` ids.

    A document is its ids plus the end id; a null or empty text is the end id alone. Pieces fall into reciprocal
    classes: class k takes k pieces of at most capacity // k ids, so every bin of a class holds the same number of
    pieces and workers fill bins from a running number alone. What is left of each class is packed in one small task.
    Repeated rows (also of one doc_id) are packed as rows of their own; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k long"
    pieces = written(docs.select(F.col("doc_id").cast("long"), "text")
                     .mapInArrow(token_pieces(path, capacity, tolerance), schema))
    counts = {r.k: r.n for r in pieces.groupBy("k").agg(F.count("*").alias("n")).collect()}  # a row a class: <= capacity
    base, firsts = 0, []
    for k in sorted(counts):
        firsts.append((k, base, counts[k] // k * k))
        base += counts[k] // k
    classes = F.broadcast(spark.createDataFrame(firsts, "k long, first_bin long, whole long"))
    ranked = numbered(pieces, "k", [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], "rank").join(classes, "k")
    ranked = written(ranked)
    bin_of = F.expr("first_bin + rank div k")
    before = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = (ranked.where("rank < whole").withColumn("sequence_id", bin_of)
             .select(*keep, "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")))
    rest = (ranked.where("rank >= whole").select(*keep)
            .groupBy().applyInPandas(fill_rest(capacity), ", ".join(f"{c} long" for c in [*keep, "bin", "offset"]))
            .select(*keep, (F.col("bin") + base).alias("sequence_id"), "offset"))
    return whole.union(rest)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_harmonic_packing")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return pack(documents(spark, sf), tokenizer_path())
