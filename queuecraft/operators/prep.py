"""Imputation, scaling and one-hot encoding, fitted on one frame and applied to others.

A fitted object holds only column names and a few numbers per column.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from queuecraft.operators import ordering
from queuecraft.session import written

UNKNOWN = "Unknown"
PROPOSERS = 50_000      # rows that propose medians


CHUNK = 8               # columns that one aggregation holds: wider ones compile to methods the JVM never optimises


def _by_column(df: DataFrame, columns: Sequence[str], measures: Callable[[str], dict[str, Column]]) -> dict[str, Row]:
    """A few aggregates of each column, by column, in one job. The columns are aggregated in small groups side by side; each
    group reads its own columns alone."""
    cell = lambda c: F.struct(F.lit(c).alias("feature"), *[m.alias(name) for name, m in measures(c).items()])
    parts = [df.agg(F.array(*map(cell, columns[at:at + CHUNK])).alias("_cells")).select(F.inline("_cells"))
             for at in range(0, len(columns), CHUNK)]
    return {r["feature"]: r for r in reduce(DataFrame.unionByName, parts).collect()} if parts else {}


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Medians of several columns, exact. Some rows propose them; one pass over all rows counts the values below and up to
    each proposal, which settles every column whose middle values are equal to it. The others are groups of the unfolded
    table: only the cost rests on the proposals."""
    columns = list(dict.fromkeys(columns))
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"_v{j}") for j, c in enumerate(columns)])
    some = values.sample(min(1.0, PROPOSERS / max(1, values.count())), seed=0)
    tried = {f"_v{j}": (found or [0.0])[0] for j, found in enumerate(some.approxQuantile(values.columns, [0.5], 0.001) if columns else [])}
    counts = _by_column(values, list(tried), lambda c: {
        "n": F.count(c), "below": F.count(F.when(F.col(c) < tried[c], 1)), "upto": F.count(F.when(F.col(c) <= tried[c], 1))})
    settled = {c: tried[c] for c, r in counts.items() if r["n"] and r["below"] <= (r["n"] - 1) // 2 and r["n"] // 2 < r["upto"]}
    rest = [c for c, r in counts.items() if r["n"] and c not in settled]
    if rest:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in rest])
        rows = ordering.quantiles(values.select(F.inline(cells)), "value", {"median": 0.5}, by=["feature"]).collect()
        settled |= {r["feature"]: r["median"] for r in rows}
    return {columns[int(c[2:])]: m for c, m in settled.items()}


def fill_values(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(float(v)))
                           for c, v in values.items()})


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column keeps its scale."""
    found = _by_column(df, list(columns), lambda c: {"m": F.avg(c), "s": F.stddev_pop(c)})
    return {c: (found[c]["m"] or 0.0, found[c]["s"] or 1.0) for c in columns}


def scale(df: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in moments.items()})


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels per column, null read as "Unknown". They become the model's columns: their number is its width."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("level"))
                      for c in columns])
    seen = df.select(F.inline(cells)).distinct()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in seen.collect():        # one row per column of the model
        levels[r["name"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot_names(levels: dict[str, list[str]]) -> list[str]:
    return [f"{c}_{level}" for c, values in levels.items() for level in values]


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """0/1 columns ``column_level``; an unseen level is all zeros."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
    return df.withColumns({f"{c}_{level}": (text(c) == level).cast("int") for c, values in levels.items() for level in values})


PARTS = 10_000          # levels with more than a PARTS-th of all cells are at most PARTS: they go to every task


@dataclass(frozen=True)
class WideLevels:
    """Levels of columns that may have millions of them: a written table (name, level, place, n), numbered from 0 in the
    order of the level inside each column, and how many each column has."""

    path: str
    columns: tuple[str, ...]
    sizes: tuple[int, ...]

    @property
    def width(self) -> int:
        return sum(self.sizes)


def _level_cells(columns: Sequence[str]):
    return F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("level")) for c in columns]))


def fit_wide_levels(df: DataFrame, columns: Sequence[str], path: str) -> WideLevels:
    """Number the levels of each column, null read as "Unknown". Only one size per column comes to the driver."""
    seen = df.select(_level_cells(columns)).groupBy("name", "level").agg(F.count("*").alias("n"))
    placed = ordering.with_rank(seen, "level", "level", by=["name"], descending=False, rank="place", total="_n")
    placed.select("name", "level", (F.col("place") - 1).alias("place"), "n").write.mode("overwrite").parquet(path)
    found = {r["name"]: r["size"] for r in df.sparkSession.read.parquet(path).groupBy("name").agg(F.count("*").alias("size")).collect()}
    return WideLevels(path, tuple(columns), tuple(found.get(c, 0) for c in columns))


def encode_wide(df: DataFrame, key: str, levels: WideLevels, out: str = "features") -> DataFrame:
    """(key, sparse 0/1 vector): each cell joined with its level's number behind the columns before; an unseen level sets
    nothing. ``key`` names a row. Frequent levels go to every task, all others meet their cells by a shuffle."""
    starts = {c: sum(levels.sizes[:i]) for i, c in enumerate(levels.columns)}
    table = df.sparkSession.read.parquet(levels.path)
    total = table.agg(F.sum("n")).first()[0] or 0
    at = F.create_map(*[x for c, start in starts.items() for x in (F.lit(c), F.lit(start).cast("long"))])
    table = table.select("name", "level", (F.col("place") + at[F.col("name")]).cast("int").alias("at"), "n")
    common = F.broadcast(table.filter(F.col("n") * PARTS > total).drop("n"))
    rare = table.filter(F.col("n") * PARTS <= total).drop("n")
    cells = df.select(key, _level_cells(levels.columns))
    placed = cells.join(common, ["name", "level"]).unionByName(
        cells.join(common.drop("at"), ["name", "level"], "left_anti").join(rare, ["name", "level"], "left"))
    width = levels.width
    sparse = F.udf(lambda at: Vectors.sparse(width, at, [1.0] * len(at)), VectorUDT())
    return placed.groupBy(key).agg(F.sort_array(F.collect_list("at")).alias("_at")).select(key, sparse("_at").alias(out))


@dataclass
class Preprocessor:
    """Median fill and scaling of numeric columns, one-hot encoding of categorical ones."""

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    moments: dict[str, list[float]] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> "Preprocessor":
        medians = exact_medians(train, numeric) if numeric else {}
        medians = {c: medians.get(c, 0.0) for c in numeric}
        moments = fit_moments(fill_values(train, medians), numeric) if numeric else {}
        return cls(list(numeric), list(categorical), medians, {c: list(v) for c, v in moments.items()},
                   fit_levels(train, categorical) if categorical else {})

    @property
    def feature_names(self) -> list[str]:
        return [*self.numeric, *one_hot_names(self.levels)]

    def transform(self, df: DataFrame, keep: Sequence[str] = (), features: Sequence[str] | None = None,
                  vector: str | None = None) -> DataFrame:
        """Encoded columns in fitted order; ``features`` picks a named subset, ``vector`` assembles them."""
        wanted = list(features or self.feature_names)
        filled = one_hot(scale(fill_values(df, self.medians), self.moments), self.levels)
        out = filled.select(*keep, *[F.col(f"`{c}`") for c in wanted])
        if vector is None:
            return out
        # neutral names: a level may hold characters an assembler would read as a path
        plain = out.toDF(*keep, *[f"_f{i}" for i in range(len(wanted))])
        made = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(wanted))], outputCol=vector).transform(plain)
        return made.select(*keep, vector)

    def places(self, numeric: Sequence[str], categorical: Sequence[str]) -> list[int]:
        """Where the features of some of the columns stand in the vector, in the order of a preprocessor of those alone."""
        at, found = len(self.numeric), {}
        for c, values in self.levels.items():
            found[c] = range(at, at + len(values))
            at += len(values)
        return [*[self.numeric.index(c) for c in numeric], *[j for c in categorical for j in found[c]]]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "Preprocessor":
        return cls(**json.loads(text))


def fit_folds(df: DataFrame, fold: str, folds: int, numeric: Sequence[str], categorical: Sequence[str]) -> list[Preprocessor]:
    """The preprocessor of every fold's training rows (all rows of the other folds), from one pass over ``df``.

    Every (column, value) is counted once, with one counter a fold; what a fold trains on is the total less its own
    count. Medians of all folds come from one set of running sums over those counts, moments from one more aggregation.
    """
    def cell(c: str, value, level):
        return F.struct(F.lit(c).alias("feature"), value.cast("double").alias("value"), level.alias("level"))

    nothing = F.lit(None).cast("string")
    cells = [cell(c, F.nanvl(F.col(c).cast("double"), F.lit(None)), nothing) for c in numeric]
    cells += [cell(c, F.lit(None), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))) for c in categorical]
    own = [F.count(F.when(F.col(fold) == i, 1)).alias(f"own{i}") for i in range(folds)]
    counted = df.select(fold, F.inline(F.array(*cells))).groupBy("feature", "value", "level").agg(F.count("*").alias("n"), *own)
    counts = written(counted.select("feature", "value", "level", *[(F.col("n") - F.col(f"own{i}")).alias(f"n{i}") for i in range(folds)]))

    levels: list[dict[str, list[str]]] = [{c: [] for c in categorical} for _ in range(folds)]
    for r in counts.filter(F.col("level").isNotNull()).collect() if categorical else []:
        for i in range(folds):
            if r[f"n{i}"]:
                levels[i][r["feature"]].append(r["level"])

    medians: list[dict[str, float]] = [{c: 0.0 for c in numeric} for _ in range(folds)]
    moments: list[dict[str, list[float]]] = [{} for _ in range(folds)]
    if numeric:
        numbers = counts.filter(F.col("level").isNull())
        run = ordering.running_sums(numbers.filter(F.col("value").isNotNull()), "value",
                                    {str(i): F.col(f"n{i}") for i in range(folds)}, by=["feature"], descending=False)

        def middle(i: int, place):      # the value at a 1-based place among the fold's training rows
            return F.max(F.when((F.col(f"cum_{i}") >= place) & (F.col(f"cum_{i}") - F.col(f"n{i}") < place), F.col("value")))

        low, high = ((lambda i: F.floor((F.col(f"tot_{i}") - 1) / 2) + 1), (lambda i: F.floor(F.col(f"tot_{i}") / 2) + 1))
        found = run.groupBy("feature").agg(*[((middle(i, low(i)) + middle(i, high(i))) / 2).alias(f"m{i}") for i in range(folds)]).collect()
        for r in found:
            for i in range(folds):
                medians[i][r["feature"]] = float(r[f"m{i}"] or 0.0)
        table = df.sparkSession.createDataFrame([(c, [medians[i][c] for i in range(folds)]) for c in numeric], "feature string, m array<double>")
        gap = lambda i: F.coalesce(F.col("value"), F.col("m")[i]) - F.col("m")[i]
        sums = numbers.join(table, "feature").groupBy("feature").agg(*[
            F.sum(F.col(f"n{i}") * part).cast("double").alias(f"{name}{i}") for i in range(folds)
            for name, part in (("c", F.lit(1)), ("s", gap(i)), ("q", gap(i) * gap(i)))]).collect()
        for r in sums:
            for i in range(folds):
                n = r[f"c{i}"] or 1.0
                shift = r[f"s{i}"] / n
                spread = max(0.0, r[f"q{i}"] / n - shift * shift) ** 0.5
                moments[i][r["feature"]] = [medians[i][r["feature"]] + shift, spread or 1.0]
    return [Preprocessor(list(numeric), list(categorical), medians[i], {c: moments[i].get(c, [0.0, 1.0]) for c in numeric},
                         {c: sorted(levels[i][c]) for c in categorical}) for i in range(folds)]


def transform_folds(df: DataFrame, ready: Sequence[Preprocessor], keep: Sequence[str], vector: str = "features") -> DataFrame:
    """The vectors of every fold's preprocessor side by side, ``vector_0``, ``vector_1``, ...: one scan encodes all folds.

    Columns are read, cast and compared with their levels once; only fill and scale are a fold's own.
    """
    numeric, categorical = ready[0].numeric, ready[0].categorical
    hot = {cell: f"_h{j}" for j, cell in enumerate(sorted({(c, level) for r in ready for c in categorical for level in r.levels[c]}))}
    read = df.select(*keep, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"_x{j}") for j, c in enumerate(numeric)],
                     *[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(f"_c{j}") for j, c in enumerate(categorical)])
    own = [((F.coalesce(F.col(f"_x{j}"), F.lit(float(r.medians[c]))) - F.lit(r.moments[c][0])) / F.lit(r.moments[c][1])).alias(f"_f{i}_{j}")
           for i, r in enumerate(ready) for j, c in enumerate(numeric)]
    made = read.select(*keep, *own, *[(F.col(f"_c{categorical.index(c)}") == level).cast("int").alias(name) for (c, level), name in hot.items()])
    for i, r in enumerate(ready):
        cells = [*[f"_f{i}_{j}" for j in range(len(numeric))], *[hot[c, level] for c in categorical for level in r.levels[c]]]
        made = VectorAssembler(inputCols=cells, outputCol=f"{vector}_{i}").transform(made)
    return made.select(*keep, *[f"{vector}_{i}" for i in range(len(ready))])


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives over positives, with both counts."""
    counts = df.agg(F.sum((F.col(label) == 0).cast("long")).alias("negatives"), F.sum((F.col(label) == 1).cast("long")).alias("positives"))
    return counts.withColumn("positive_weight", F.try_divide(F.col("negatives").cast("double"), F.col("positives")))


def add_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weight = class_weight(df, label).first()["positive_weight"] or 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(weight)).otherwise(1.0))
