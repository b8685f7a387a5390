"""Every stage on its own input against a plain version of it."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from stratamart.llm import packing, quality, toxicity
from stratamart.llm.common import stored, table
from tests.llm.test_jaccard_join import brute
from tests.llm.test_models import ODD

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    """Each stage's documents, as the pipeline hands them on."""
    docs, out = table(spark, FOLDER, "documents"), {}
    for name, stage in P.STAGES:
        out[name] = docs
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
    out["result"] = docs
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(inputs):
    for name, _ in P.STAGES:
        assert inputs[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage(spark, inputs):
    docs, labels = inputs["quality"], table(spark, FOLDER, "labels")
    model = quality.fit_evidence(docs, labels)
    rows = docs.collect()
    good = model.good(pa.array([r.text for r in rows]))
    sites = {(r.host, r.path): r for r in quality.site_posteriors(
        spark.createDataFrame([(r.source, r.lang, float(g)) for r, g in zip(rows, good)], "host string, path string, good double")).collect()}

    def logit(p):
        import math

        p = max(1e-6, min(1 - 1e-6, p))
        return math.log(p / (1 - p))

    kept = []
    for r, g in zip(rows, good):
        s = sites[r.source, r.lang]
        others = (s.strength * s.prior + s.total - g) / (s.strength + s.n - 1)
        if logit(g) + logit(others) - logit(s.rate) >= 0:
            kept.append(r.doc_id)
    assert ids(inputs["toxicity"]) == sorted(kept) and len(kept) < len(rows)


def test_toxicity_stage(spark, inputs):
    docs = inputs["toxicity"]
    model = toxicity.fit(docs, table(spark, FOLDER, "labels"))
    kept = [r.doc_id for r in docs.collect() if model.score(r.text) < toxicity.THRESHOLD]
    assert ids(inputs["near_duplicates"]) == sorted(kept)


def test_near_duplicate_stage(inputs):
    rows = [(r.doc_id, r.text) for r in inputs["near_duplicates"].collect()]
    assert ids(inputs["packing"]) == sorted({c for _, _, c in brute(rows, 5, 80)})


def test_packing_stage(inputs):
    want = sorted((r.doc_id, sum(-(-len(w) // 16) for w in (r.text or "").split())) for r in inputs["packing"].collect())
    out = inputs["result"].toPandas()
    assert sorted(zip(out.doc_id, out.n_tokens)) == want
    assert (out.n_tokens <= out.bound).all()
    assert set(out.bound) <= set(packing.best_bounds(*np.unique(out.n_tokens.to_numpy(), return_counts=True), packing.BUCKETS))


def test_run_equals_the_stages(spark, inputs):
    got = P.run(spark, FOLDER)
    assert got.columns == inputs["result"].columns
    assert ids(got) == ids(inputs["result"])


def test_odd_rows_and_empty_tables(spark, tmp_path):
    rows = [(i, t, "en", None, None) for i, t in enumerate(ODD)] + [(100, "one two three four five six", None, "s", 1)] * 3 + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            frame = stored(stage(spark, frame, str(tmp_path)), "test-odd")
        assert frame.columns == ["doc_id", "n_tokens", "bucket", "bound", "batch", "slot"]
    kept = P.near_duplicates(spark, docs, str(tmp_path))
    # Textless documents stay; the repeated row stays once, as does the row without an id.
    assert kept.where(F.col("doc_id") == 100).count() == 1 and kept.where(F.col("doc_id").isNull()).count() == 1
    assert kept.count() == len(ODD) + 2
