"""A fitted scorer on a stream: equal to stored rows, replaced between micro-batches, and the same for a repeated batch."""

import dataclasses
import os
import shutil

import pytest
from pyspark.ml.classification import LogisticRegressionModel

from queuecraft.plans import model_queries as M
from queuecraft.plans import views as V
from queuecraft.session import scratch_path
from queuecraft.sources import artifacts
from queuecraft.streaming import scoring


@pytest.fixture(scope="module")
def fitted(spark, sf):
    return M.fitted_artifacts(spark, sf)


def _scores(df):
    return {r[M.KEY]: (r["score"], r["bucket"]) for r in df.collect()}


def test_claims_on_a_stream_score_as_stored_ones(spark, sf, tmp_path, fitted):
    orders = V.table(spark, sf, "orders")
    inbox, scorers, out, marks = str(tmp_path / "in"), str(tmp_path / "scorers"), str(tmp_path / "out"), str(tmp_path / "marks")
    stream = lambda: V.claims_of(spark.readStream.schema(orders.schema).parquet(inbox))
    os.mkdir(inbox)
    with pytest.raises(artifacts.MissingArtifact):
        scoring.newest(spark, scorers)
    assert scoring.publish(fitted, spark, scorers) == 1 == scoring.newest(spark, scorers)

    early, late = orders.filter("o_orderkey % 3 = 0"), orders.filter("o_orderkey % 3 <> 0")
    early.coalesce(1).write.mode("append").parquet(inbox)
    first = scoring.score_stream(stream(), scorers, M.KEY, ["Age"], out, marks)
    assert first.columns == [M.KEY, "Age", "score", "bucket", "version"] and {r.version for r in first.collect()} == {1}
    assert _scores(first) == _scores(artifacts.score_claims(V.claims_of(early), fitted, M.KEY))

    # a second scorer with other thresholds takes over between two micro-batches
    cuts = sorted(s for s, _ in _scores(first).values())
    second = dataclasses.replace(fitted, bundle=dataclasses.replace(fitted.bundle, top_threshold=cuts[-5], mid_threshold=cuts[-50]))
    assert scoring.publish(second, spark, scorers) == 2
    late.coalesce(1).write.mode("append").parquet(inbox)
    both = scoring.score_stream(stream(), scorers, M.KEY, ["Age"], out, marks)
    assert both.count() == orders.count()
    assert _scores(both.filter("version = 1")) == _scores(first)
    assert _scores(both.filter("version = 2")) == _scores(artifacts.score_claims(V.claims_of(late), second, M.KEY))

    # the last batch runs again after its commit is lost: it is scored by the scorer it chose first
    scoring.publish(fitted, spark, scorers)
    last = max(os.listdir(f"{marks}/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    lost = str(tmp_path / "marks-without-the-last-commit")
    shutil.copytree(marks, lost, ignore=lambda folder, names: [n for n in names if folder.endswith("commits") and n.strip(".").split(".")[0] == last])
    again = scoring.score_stream(stream(), scorers, M.KEY, ["Age"], out, lost)
    assert {(r.version, r["count"]) for r in again.groupBy("version").count().collect()} == {(1, early.count()), (2, late.count())}


def test_a_saved_scorer_scores_raw_claims(spark, sf, fitted):
    """Train and serve: raw claims through the saved scorer equal the engineered, encoded rows through the model."""
    folder = scratch_path(spark, "test-scorer")
    artifacts.save(fitted, spark, folder)
    back = artifacts.load(spark, folder)
    assert isinstance(back.model, LogisticRegressionModel)
    got = {r[M.KEY]: r["score"] for r in artifacts.score_claims(V.claims(spark, sf), back, M.KEY).collect()}
    wide = M.claim_features.engineer(M.claim_features.impute_age(V.claims(spark, sf)))
    vectors = fitted.preprocessor.transform(wide, [M.KEY], vector="features")
    want = {r[M.KEY]: r["score"] for r in M.learn.score_with(fitted.model, vectors, [M.KEY]).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-12
    for r in artifacts.score_claims(V.claims(spark, sf), back, M.KEY).collect():
        cut = fitted.bundle
        assert r["bucket"] == ("SIU" if r["score"] >= cut.top_threshold else "Manual Review" if r["score"] >= cut.mid_threshold else "Approve")
    # a column that only the encoder reads may be missing: it is filled as unknown
    assert artifacts.score_claims(V.claims(spark, sf).drop("MaritalStatus"), back, M.KEY).count() == len(got)
