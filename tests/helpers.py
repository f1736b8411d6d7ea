"""Brute-force versions of the ranking definitions, over plain Python lists."""

from __future__ import annotations

import math


def ordered(rows):
    """Rows (id, score, label) from the best score down, ids breaking ties."""
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def average_precision(rows):
    total, hits, seen, area, before = sum(r[2] for r in rows), 0, 0, 0.0, 0.0
    for score in sorted({r[1] for r in rows}, reverse=True):
        here = [r for r in rows if r[1] == score]
        hits, seen = hits + sum(r[2] for r in here), seen + len(here)
        area += (hits / total - before) * hits / seen
        before = hits / total
    return area


def roc_auc(rows):
    pos, neg = [r[1] for r in rows if r[2]], [r[1] for r in rows if not r[2]]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def quantile(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low = math.floor(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def ks_distance(a, b):
    share = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    return max(abs(share(a, v) - share(b, v)) for v in {*a, *b})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
