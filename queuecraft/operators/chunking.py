"""Documents cut into passages: sections first, then paragraphs packed up to a size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Section mark, paragraph mark, passage size in characters.
SECTION = "\n## "
HEADING = "## "
PARAGRAPH = "\n\n"
SIZE = 500


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def _strip(c: Column) -> Column:
    """Cut white space at both ends: ASCII kinds, the separators, and Unicode spaces."""
    return F.regexp_replace(c, r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", "")


def sections(text: Column, mark: str = SECTION, heading: str = HEADING) -> Column:
    """Sections with the heading mark put back on all but the first."""
    parts = F.split(text, _quoted(mark), -1)
    return F.transform(parts, lambda s, i: F.when(i > 0, F.concat(F.lit(heading), s)).otherwise(s))


def pack(section: Column, size: int = SIZE, mark: str = PARAGRAPH) -> Column:
    """Greedy packing: paragraphs are joined while they fit; a longer one stands alone, whole.

    A section within the size is one passage, even when blank; blank packed passages are dropped.
    """
    gap = len(mark)
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, paragraph: Column) -> Column:
        fits = F.length(acc["open"]) + F.length(paragraph) + gap <= size
        closed = F.when(fits | (_strip(acc["open"]) == ""), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["open"])))
        text = F.concat(F.when(fits, acc["open"]).otherwise(F.lit("")), paragraph, F.lit(mark))
        return F.struct(closed.alias("done"), text.alias("open"))

    def finish(acc: Column) -> Column:
        return F.filter(F.transform(F.concat(acc["done"], F.array(acc["open"])), _strip), lambda c: c != "")

    packed = F.aggregate(F.split(section, _quoted(mark), -1), empty, step, finish)
    return F.when(F.length(section) <= size, F.array(_strip(section))).otherwise(packed)


def split_sections(docs: DataFrame, text: str, key: str, mark: str = SECTION, heading: str = HEADING) -> DataFrame:
    return docs.select(key, F.posexplode(sections(F.col(text), mark, heading)).alias("section_id", "section"))


def chunk(docs: DataFrame, text: str, key: str, *, size: int = SIZE, section_mark: str = SECTION, heading: str = HEADING,
          paragraph_mark: str = PARAGRAPH) -> DataFrame:
    """(key, chunk_id, text) of a whole table; ids restart at 0 in each document. No shuffle."""
    passages = F.flatten(F.transform(sections(F.col(text), section_mark, heading), lambda s: pack(s, size, paragraph_mark)))
    return docs.select(key, F.posexplode(passages).alias("chunk_id", "text"))
