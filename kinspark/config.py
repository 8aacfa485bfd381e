"""Settings as frozen dataclasses, with the same keys and defaults as the YAML file."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class Paths:
    train_dir: str = "dataset/train"
    test_dir: str = "dataset/test"
    train_sources: tuple[str, ...] = ("train_source1.tsv", "train_source2.tsv", "train_source3.tsv")
    test_sources: tuple[str, ...] = ("test_source1.tsv", "test_source2.tsv", "test_source3.tsv")
    output_dir: str = "output"
    cache_dir: str = "cache"
    model_path: str = "cache/model"
    normalize_chunk_size: int = 100_000


@dataclass(frozen=True)
class Blocking:
    """Bounds of document frequency for each kind of key; ``rank_candidates`` keeps those with most shared keys instead of the least ids.

    ``use_lsh`` adds keys of least hashes, whose bands aim at ``minhash_threshold``. ``n_jobs`` and ``chunk_size`` are read and have no
    effect: Spark partitions the work."""

    rare_token_df_min: int = 2
    rare_token_df_max: int = 200
    char_ngram_n: int = 3
    minhash_threshold: float = 0.5
    addr_token_df_max: int = 300
    use_lsh: bool = False
    loc_token_df_max: int | None = 500
    pin_token_df_max: int = 300
    max_candidates_per_entity: int | None = 150
    n_jobs: int = 2
    chunk_size: int = 100_000
    rank_candidates: bool = False


@dataclass(frozen=True)
class Model:
    n_estimators: int = 900
    learning_rate: float = 0.03
    num_leaves: int = 63
    min_child_samples: int = 40
    subsample: float = 0.9
    colsample_bytree: float = 0.9
    reg_lambda: float = 1.0
    n_folds: int = 3
    calibrate: bool = True
    max_train_pairs: int = 3_000_000
    tfidf_max_features: int = 100_000
    tfidf_min_df: int = 2
    tfidf_fit_sample_per_frame: int = 500_000


@dataclass(frozen=True)
class Decision:
    t_open_grid: tuple[float, float, float] = (0.30, 0.94, 0.02)
    t_add_grid: tuple[float, float, float] = (0.20, 0.94, 0.02)
    greedy_per_entity: bool = True
    max_matches: int = 0


@dataclass(frozen=True)
class Config:
    paths: Paths = field(default_factory=Paths)
    blocking: Blocking = field(default_factory=Blocking)
    model: Model = field(default_factory=Model)
    decision: Decision = field(default_factory=Decision)
    team_name: str = "myteam"


def _part(kind: type, given: dict | None):
    known = {f.name for f in fields(kind)}
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in (given or {}).items() if k in known})


def load_config(path: str) -> Config:
    """Read a YAML file; missing keys keep their defaults, unknown keys are ignored."""
    import yaml

    given = yaml.safe_load(Path(path).read_text()) or {}
    parts = {"paths": Paths, "blocking": Blocking, "model": Model, "decision": Decision}
    return Config(**{k: _part(kind, given.get(k)) for k, kind in parts.items()}, team_name=given.get("team_name", "myteam"))
