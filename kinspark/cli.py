"""Command line: ``python -m kinspark.cli [--config FILE] [STAGE]``; stages from TSV files to a packaged result.

Stages hand tables on in ``cache_dir`` as Parquet, so any of them can run again by itself; without a stage all run in order."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.config import Config, load_config
from kinspark.functions.normalize import normalize
from kinspark.operators import blocking, checks, decide, features, model, profile, sampling, tfidf
from kinspark.sources import tables


class Run:
    """One run: the session, the settings and the tables between stages."""

    def __init__(self, spark: SparkSession, cfg: Config):
        self.spark, self.cfg = spark, cfg

    def path(self, name: str) -> str:
        return tables.cache_path(self.cfg.paths.cache_dir, name)

    def kept(self, name: str, df: DataFrame) -> DataFrame:
        return tables.write_cache(df, self.path(name))

    def read(self, name: str) -> DataFrame:
        return tables.read_cache(self.spark, self.path(name))

    def side(self, split: str, query: bool) -> DataFrame:
        rows = self.read(f"{split}_normalized")
        return rows.where("source = 1" if query else "source <> 1")

    def output(self, name: str) -> str:
        return f"{self.cfg.paths.output_dir.rstrip('/')}/{name}"


def prep(run: Run) -> None:
    """Both splits normalized, and the truth; prints figures of the training data."""
    paths = run.cfg.paths
    for split, folder, names in (("train", paths.train_dir, paths.train_sources), ("test", paths.test_dir, paths.test_sources)):
        rows = tables.read_sources(run.spark, folder, split, names)
        run.kept(f"{split}_normalized", normalize(rows, phonetic="metaphone"))
    truth = tables.truth_pairs(tables.read_truth(run.spark, f"{paths.train_dir}/train_ground_truth.tsv"))
    truth = run.kept("train_truth", truth)
    sizes = profile.truth_sizes(run.side("train", True), truth)
    for title, found in (("singletons", profile.singletons(sizes)), ("matches", profile.match_histogram(sizes)), ("repeated ids", profile.repeated_ids(truth)), ("countries", profile.country_counts(run.read("train_normalized")))):
        print(f"[prep] {title}: {[tuple(r) for r in found.take(50)]}")


def block(run: Run) -> None:
    """Candidates of both splits; those of the test split also as a result file."""
    for split in ("train", "test"):
        pairs = blocking.candidates(run.side(split, True), run.side(split, False), run.cfg.blocking)
        run.kept(f"{split}_candidates", pairs)
    queries, pairs = run.side("test", True), run.read("test_candidates")
    tables.write_candidates(blocking.candidate_lists(queries, pairs), run.output("candidate_pairs.tsv"))
    print(f"[block] average candidates: {blocking.average_candidates(queries, pairs).first()[0]:.1f}")


def featurize(run: Run) -> None:
    """TF-IDF vectors over both splits."""
    both = run.read("train_normalized").unionByName(run.read("test_normalized"))
    cfg = run.cfg.model
    run.kept("vectors", tfidf.fit_weights(both, cfg.tfidf_max_features, cfg.tfidf_min_df, cfg.tfidf_fit_sample_per_frame))


def _features(run: Run, split: str, pairs: DataFrame) -> DataFrame:
    vectors = run.read("vectors").where(F.col("split") == split)
    return features.pair_features(pairs, run.side(split, True), run.side(split, False), vectors)


def train(run: Run) -> None:
    """Out-of-fold scores for the thresholds, then the model of all training pairs."""
    cfg, queries, pairs, truth = run.cfg, run.side("train", True), run.read("train_candidates"), run.read("train_truth")
    sample = sampling.budget_sample(queries, pairs, truth, cfg.model.max_train_pairs).select("s1_id")
    rows = features.with_labels(_features(run, "train", pairs.join(sample, "s1_id", "left_semi")), truth)
    rows = run.kept("train_pairs", rows)
    scored = run.kept("out_of_fold", model.out_of_fold(rows, cfg.model))
    model.train(rows, cfg.model).save(cfg.paths.model_path)
    entities = rows.select("s1_id").distinct()
    scores = decide.threshold_scores(entities, decide.scored_lists(scored), truth, cfg.decision)
    best = decide.best_thresholds(scores).first()
    tables.write_thresholds(f"{cfg.paths.cache_dir}/thresholds.json", best["t_open"], best["t_add"], best["macro_f05"])
    print(f"[train] out of fold: {best.asDict()}")


def predict(run: Run) -> None:
    """Scores of the test candidates, and each entity's matches as a result file."""
    cfg = run.cfg
    found = model.Matcher.load(cfg.paths.model_path)
    cut = tables.read_thresholds(f"{cfg.paths.cache_dir}/thresholds.json")
    lists = decide.scored_lists(run.kept("test_scores", found.score(_features(run, "test", run.read("test_candidates")))))
    picks = lists.select("s1_id", decide.greedy_picks(F.col("scored"), cut["t_open"], cut["t_add"], cfg.decision.max_matches).alias("ids"))
    none = F.array().cast("array<string>")
    every = run.side("test", True).select(F.col("entity_id").alias("s1_id")).join(picks, "s1_id", "left").select("s1_id", F.coalesce("ids", none).alias("ids"))
    tables.write_results(every, run.output("matching_results.tsv"))


def validate(run: Run) -> DataFrame:
    """Checks of the written result; prints the first problems."""
    matches = tables.read_lists(run.spark, run.output("matching_results.tsv"), "matched_entity_ids")
    listed = tables.read_lists(run.spark, run.output("candidate_pairs.tsv"), "candidate_entity_ids")
    pairs = listed.select("s1_id", F.explode("ids").alias("cand_id"))
    found = checks.problems(matches, pairs, run.side("test", True), run.side("test", False))
    print(f"[validate] {[tuple(r) for r in found.take(20)] or 'no problems'}")
    return found


def package(run: Run) -> None:
    """The output folder and the code in one archive."""
    target = f"{run.cfg.team_name}_submission.zip"
    tables.package(run.cfg.paths.output_dir, str(Path(__file__).resolve().parent), target)
    print(f"[package] {target}")


STAGES = {f.__name__: f for f in (prep, block, featurize, train, predict, validate, package)}


def run_stages(spark: SparkSession, cfg: Config, names: list[str] | None = None) -> None:
    """The named stages, or all of them in order; an unknown name raises KeyError."""
    run = Run(spark, cfg)
    for name in names or list(STAGES):
        STAGES[name](run)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("stage", nargs="?", default="all", choices=["all", *STAGES])
    given = parser.parse_args(args)
    cfg = load_config(given.config) if Path(given.config).exists() else Config()
    run_stages(SparkSession.builder.getOrCreate(), cfg, None if given.stage == "all" else [given.stage])


if __name__ == "__main__":
    main()
