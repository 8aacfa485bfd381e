"""Queries do their whole job: settings as configured, every row answered."""

import inspect

from kinspark.config import Model
from kinspark.operators import model
from kinspark.operators.features import FEATURES
from kinspark.plans import catalogue


def test_model_is_trained_with_the_configured_settings():
    assert inspect.signature(catalogue._trained).parameters["cfg"].default == Model()


def test_pairs_beyond_the_budget_are_scored(spark):
    """Entities 0-5 make the models, 6-8 are scored by a model of all of them."""
    rows = [(f"S1-{k // 8}", f"S2-{k}", *(float((k * 7 + j) % 5) for j in range(len(FEATURES))), int(k % 4 == 0)) for k in range(72)]
    pairs = spark.createDataFrame(rows, ["s1_id", "cand_id", *FEATURES, "label"]).coalesce(1)
    trained = pairs.select("s1_id").distinct().where("s1_id < 'S1-6'")
    got = model.score_all(pairs, trained, Model(n_estimators=1, num_leaves=1, n_folds=2, calibrate=False, min_child_samples=1)).collect()
    assert sorted((r.s1_id, r.cand_id) for r in got) == sorted(r[:2] for r in rows)
    assert all(0 <= r.p <= 1 for r in got)


def test_the_full_grid_of_all_picks_has_all_cells(spark, sf_dir):
    assert catalogue.QUERIES["threshold_grid_nongreedy_full"](spark, sf_dir).count() == 726
