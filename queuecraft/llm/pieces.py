"""SentencePiece encoding and decoding through a table of distinct marked words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import documents
from queuecraft.llm.registry import query

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CACHED_WORDS = 200_000  # a worker's word table is emptied beyond this; it only saves repeated work


def marked_words(text: str) -> list[str]:
    """The text's marked words, each without its first mark: a run of marks and what follows up to the next mark.

    The library puts a mark in front of the text and writes blanks as marks.
    """
    if not text:
        return []
    text = text.replace(" ", MARK)
    if MARK * 2 not in text and text[0] != MARK and text[-1] != MARK:
        return text.split(MARK)
    return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + text)]


def load(path: str):
    """The processor, after a check of what the word table rests on: no piece has a mark behind another character,
    so no merge joins two marked words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size())):
        raise ValueError("pieces of this model cross white space; it has no table of distinct words")
    return model


def segment(path: str):
    """Arrow function: (doc_id, text) to (doc_id, ids, decoded)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        end, lone = model.eos_id(), [model.piece_to_id(MARK)]
        codes: dict[str, list[int]] = {}
        plain: dict[str, str] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words = [marked_words(t) for t in part.column(1).to_pylist()]
                if len(codes) > CACHED_WORDS:
                    codes.clear()
                    plain.clear()
                new = [w for w in set().union(*words) if w not in codes]
                # the library adds the word's first mark again; a lone mark is not what it makes of an empty text
                for word, ids in zip(new, model.encode([w.replace(MARK, " ") for w in new], num_threads=1)):
                    codes[word] = ids or lone
                decoded = model.decode([codes[w] for w in new], num_threads=1) if new else []
                plain.update(zip(new, decoded))
                ids = [[i for w in own for i in codes[w]] + [end] for own in words]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())),
                     pa.array([" ".join(map(plain.__getitem__, own)) for own in words], pa.string())],
                    names=["doc_id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids: array<int> with the end id, decoded: string) of every row.

    Null and empty texts have the end id alone and decode to an empty text. Repeated rows stay; an empty table gives
    an empty result; other columns are not looked at.
    """
    return docs.select("doc_id", "text").mapInArrow(
        segment(path), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_distinct_word_pieces")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return encode_decode(documents(spark, sf), model_path()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
