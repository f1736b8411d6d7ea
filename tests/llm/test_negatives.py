"""Hard negatives against a plain version with Python integers."""

import math
import random

import numpy as np
import pytest

from queuecraft.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score double, rank int"


def plain(rows):
    rows = {(i, (l + 1) % 10 if i % 7 == 0 else l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows
            if i is not None and v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in rows:
        if a[0] % 50 == 0:
            others = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in rows if b != a and len(b[2]) == len(a[2]))
            for s, p, _ in [o for o in others if o[2] == a[1]][:5]:
                good = [o for o in others if o[2] != a[1] and 50 * -s <= 100 * -o[0] <= 95 * -s]
                out += [(a[0], p, k + 1, n[1], -s, -n[0]) for k, n in enumerate(good[:3])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in negatives.hard_negatives(df).collect())


@pytest.mark.parametrize("dim,top", [(64, 1), (13, 40)])
def test_scores_are_inner_products(dim, top):
    rng = np.random.default_rng(dim)
    a, c = (rng.integers(-200 * top, 200 * top, (n, dim)) for n in (9, 700))
    planes = 1 + int(200 * top).bit_length()
    bits = (c[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    codes = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
    assert (negatives.scores(a, codes) == a @ c.T).all()


def test_hard_negatives_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "CANDIDATES", 50)
    monkeypatch.setattr(negatives, "TABLE", 4096)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(13)] for _ in range(4)]
    rows = [(i, [round(x + rng.gauss(0, 0.6), 1) for x in centres[i % 4]], rng.choice([1, 1, 1, 2, 3, 9])) for i in range(400)]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], SCHEMA).repartition(4)
    want = plain(rows)
    assert len(want) > 60 and got(df) == want


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 3), (1, [1.0, 2.0], 1), (2, [1.0, 1.2], 2), (2, [1.0, 1.2], 2),
            (3, [1.0, 1.2], 2), (4, [0.9, 1.3], 4), (5, None, 1), (6, [1.0, None], 1), (8, [1.0, float("inf")], 1), (9, [float("nan"), 1.0], 2),
            (10, [1.0, 1.0], None), (None, [1.0, 1.0], 2), (50, [], 5), (51, [], 5), (52, [], 6), (100, [-1.0, 2.0, 3.0], 1), (101, [-1.0, 2.0, 2.0], 2),
            (150, [0.0, 0.0], 8), (151, [0.0, 0.0], 8), (152, [-300.5, 1000.25], 8), (200, [0.5, -0.5], 9), (201, [-0.5, 0.5], 9)]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], SCHEMA)
    want = plain(rows)
    assert len(want) > 5 and got(df) == want
    assert got(df.limit(0)) == []
    assert got(df.where("vec_id between 10 and 12")) == []
