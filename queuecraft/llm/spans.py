"""Spans (kind, begin, end) in texts: order, text form and digest columns shared by the span finders."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "spans array<struct<kind:string,begin:long,end:long,base:boolean>>"
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def in_order(base: list[tuple[int, int, str]], added: list[tuple[int, int, str]], kinds: tuple[str, ...]) -> list[dict]:
    """Spans by begin, then by kind as listed. Added spans that lie wholly inside a base span or an added one go; those
    that reach beyond one stay beside it."""
    taken = sorted(base)
    for begin, end, kind in sorted(added, key=lambda s: (s[0], -s[1])):
        if not any(b <= begin and end <= e for b, e, _ in taken):
            taken.append((begin, end, kind))
    own = set(base)
    rows = [{"kind": k, "begin": b, "end": e, "base": (b, e, k) in own} for b, e, k in taken]
    return sorted(rows, key=lambda r: (r["begin"], kinds.index(r["kind"]) if r["base"] else len(kinds), r["end"]))


def written_out(spans: Column) -> Column:
    """kind:begin:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digest_columns(kinds: tuple[str, ...]) -> list[Column]:
    """A count a kind of base spans, their digest, and all spans written out."""
    base = F.filter("spans", lambda s: s["base"])
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return [*map(count, kinds), F.sha2(written_out(base), 256).alias("base_sha256"), written_out(F.col("spans")).alias("spans")]
