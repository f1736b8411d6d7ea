"""Quality rules whose cutoffs are chosen on labelled holdouts under exact binomial bounds."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import documents, written
from queuecraft.llm.registry import query

SYMBOLS = "#*$%&|<>"
ALPHA = 0.01     # share of good documents of a stratum that all rules together may reject
DELTA = 0.05     # chance that any of the bounds fails
LADDER = (0.8, 0.6, 0.4, 0.3, 0.2, 0.1, 0.05)   # how far cutoffs lie from the good documents towards the bad ones
GOOD_LEVEL, BAD_LEVEL = 0.995, 0.9             # quantiles between which they lie
SHORT, LONG = 100, 400      # words that part the strata

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_letters",
          "n_marks", "n_distinct")
#: Rules: a number per document, of which the high end (or, with a minus, the low end) is suspect.
RULES = {
    "symbols": "n_symbols / n_words", "marks": "n_marks / n_words", "repeats": "n_repeat_words / n_words",
    "duplicate_lines": "n_dup_lines / n_words", "upper": "n_upper / n_letters", "few_letters": "-n_letters / n_chars",
    "few_different": "-n_distinct / n_words", "short_words": "-word_chars / n_words", "long_words": "word_chars / n_words",
}
STRATUM = f"case when n_words < {SHORT} then 'short' when n_words < {LONG} then 'middle' else 'long' end"

_upper = re.compile("[A-ZÀ-ÖØ-Þ]+")
_marks = re.compile("[!?]+")
_letters = re.compile(r"[^\W\d_]+")


def counts_of(text: str | None) -> tuple[int, ...]:
    """The numbers of COUNTS for one whole text; words are runs without blank, tab, line feed, VT, FF or CR."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()       # bytes split at exactly these six
    n = len(words)
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        seen = Counter(triples)
        last = -1                      # last word counted so far
        for at, triple in enumerate(triples):
            if seen[triple] > 1:
                repeated += at + 2 - max(last, at - 1)
                last = at + 2
    return (n, len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(text),
            sum(map(len, _upper.findall(text))), sum(map(len, _letters.findall(text))),
            sum(map(len, _marks.findall(text))), len(set(words)))


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            columns = list(zip(*map(counts_of, part.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in columns]],
                                             names=["doc_id", *COUNTS])


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id and the numbers of COUNTS) of every row; null texts count as empty ones."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def binomial_upper(failures: int, trials: int, delta: float) -> float:
    """Exact (Clopper-Pearson) upper bound of a probability at confidence 1 - delta."""
    if failures >= trials:
        return 1.0
    def tail(p: float) -> float:      # chance of at most ``failures``
        logs = [math.lgamma(trials + 1) - math.lgamma(k + 1) - math.lgamma(trials - k + 1)
                + (k * math.log(p) if k else 0.0) + (trials - k) * math.log1p(-p) for k in range(failures + 1)]
        top = max(logs)
        return math.exp(top) * sum(math.exp(x - top) for x in logs)
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if 0 < mid < 1 and tail(mid) > delta else (low, mid)
    return high


def rule_value(rule: str) -> Column:
    return F.coalesce(F.try_divide(*[F.expr(x) for x in RULES[rule].split(" / ")]), F.lit(0.0))


def rejected(cutoffs: list[tuple[str, str, float]]) -> Column:
    """Names of the rules that reject a row, given (stratum, rule, cutoff)."""
    checks = [F.when((F.col("stratum") == s) & (F.col(r) > c), F.lit(r)) for s, r, c in cutoffs]
    return F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")


def choose_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> list[tuple[str, str, float]]:
    """(stratum, rule, cutoff) of the rules in force; ``labelled`` has stratum, fold, good and a value per rule.

    Fold 0 proposes a ladder of cutoff sets for each stratum: every rule whose bad documents reach beyond its good
    ones gets a cutoff between the two, closer to the good ones with each step. Fold 1 tests the sets from the mildest
    on: the exact upper bound of the share of good documents that any rule of the set rejects must stay within
    ``alpha``, at confidence delta / strata. The order is fixed before fold 1 is seen and the first failing step ends
    it, so the chance of a wrong choice is delta / strata a stratum and delta in all. A stratum with too few good
    holdout documents passes no step and rejects nothing. Of the steps passed, the mildest that rejects nearly
    as many bad documents of fold 0 as the strictest is taken.
    """
    levels = {1: GOOD_LEVEL, 0: BAD_LEVEL}
    marks = {(m.stratum, m.good): m for m in labelled.where("fold = 0").groupBy("stratum", "good").agg(
        *[F.percentile_approx(r, [levels[0], levels[1]], 10_000).alias(r) for r in RULES]).collect()}
    strata = sorted({s for s, g in marks if (s, 1 - g) in marks})
    sets = {}
    for stratum in strata:
        bad, good = marks[stratum, 0], marks[stratum, 1]
        ends = [(r, good[r][1], bad[r][0]) for r in RULES if bad[r][0] > good[r][1]]
        for step, part in enumerate(LADDER):
            sets[stratum, step] = [(stratum, r, low + part * (high - low)) for r, low, high in ends]
    if not sets:
        return []
    held = labelled.where("fold = good").groupBy("stratum", "good").agg(    # bad ones that propose, good ones that test
        F.count("*").alias("n"),
        *[F.sum((F.size(rejected([c for s in strata for c in sets[s, step]])) > 0).cast("long")).alias(f"k{step}")
          for step in range(len(LADDER))]).collect()
    caught = {r.stratum: r for r in held if r.good == 0}
    out = []
    for row in (r for r in held if r.good == 1 and r.stratum in strata):
        passed = []
        for step in range(len(LADDER)):
            if binomial_upper(row[f"k{step}"], row.n, delta / len(strata)) > alpha:
                break
            passed.append(step)
        # any passed step may be taken: the mildest that catches nearly all that the strictest one does
        gain = [caught[row.stratum][f"k{step}"] for step in passed]
        out += next((sets[row.stratum, step] for step, k in zip(passed, gain) if k >= 0.99 * max(gain)), [])
    return sorted(out)


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Numbers of every row, ``base_failed``, ``kept`` and ``reasons`` (names of the rules that reject it).

    Null and empty texts have no words and fail the base rule. Labels that are null or name no document are left out;
    of several labels of one id the highest holds. Documents with the same numbers are one trial and lie in one fold: the
    bounds ask for independent trials, and copies are none. Without labels no rule but the base rule is in force. An empty
    table gives an empty result.
    """
    rows = written(counted(docs))
    marked = rows.withColumns({r: rule_value(r) for r in RULES}).withColumn("stratum", F.expr(STRATUM))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    truth = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.max("quality").alias("good")))
    labelled = (marked.where(~base).join(truth, "doc_id")
                .withColumn("copy", F.xxhash64(*COUNTS))
                .withColumn("fold", F.crc32(F.concat(F.lit("fold "), F.col("copy").cast("string"))) % 2))
    labelled = written(labelled.select("copy", "stratum", "fold", "good", *RULES).dropDuplicates(["copy", "good"]))
    cutoffs = choose_cutoffs(labelled, alpha, delta)
    out = marked.withColumn("base_failed", base).withColumn("reasons", rejected(cutoffs))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0)).drop(*RULES)


@query("op8_risk_controlled_rules")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return apply_rules(documents(spark, sf), labels).select("doc_id", *COUNTS[:5], "base_failed", "kept", "reasons")
