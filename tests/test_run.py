"""End-to-end flow on native-format files (the reference's main path)."""

import os
import tempfile

from pyspark.sql import types as T

from clickfold.operators.folds import reference_folds
from clickfold.plans.features import SCORE_START
from clickfold.plans.run import run_flow
from clickfold.sources.log import derived_log, read_log, split_train_score, write_log
from clickfold.sources.sink import read_scores
from tests.conftest import SF_SMALL


def test_native_files_to_scores(spark):
    d = tempfile.mkdtemp(prefix="clickfold-flow-")
    log = derived_log(spark, SF_SMALL, grain="second")
    train, score = split_train_score(log, SCORE_START)
    write_log(train, os.path.join(d, "train"))
    write_log(score, os.path.join(d, "score"))

    def native(schema):
        return T.StructType([T.StructField(f.name, T.LongType() if f.name == "context_timestamp"
                                           else f.dataType, True) for f in schema.fields])

    tr = read_log(spark, os.path.join(d, "train"), schema=native(train.schema))
    sc = read_log(spark, os.path.join(d, "score"), labelled=False, schema=native(score.schema))
    out = os.path.join(d, "ans")
    run_flow(spark, tr, sc, out, reference_folds(2024, 1), rounds=3,
             model_dir=os.path.join(d, "model"))
    got = read_scores(spark, out).collect()
    assert len(got) == score.count() > 0
    assert all(0.0 <= r["predicted_score"] <= 1.0 for r in got)
    assert os.path.isdir(os.path.join(d, "model"))
