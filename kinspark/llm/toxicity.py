"""Toxicity as ordered severity grades: a cumulative-link model over sparse word features, fitted on a bounded labelled sample."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .text import frees_memory, pieces

_WORD = re.compile(r"[^\W\d_]+").findall
#: Lengths of word beginnings that are features beside the word; they carry stems over to words the sample lacks.
_STEMS = (3, 4, 5, 6, 7)
#: Documents go from this probability of a grade above 0 on.
REJECT_AT = 0.2


def features_of(text: str) -> Counter:
    """How often each word, and each word beginning (with a star) of a longer word, occurs."""
    out: Counter = Counter()
    for w, n in Counter(_WORD(text.lower())).items():
        out[w] += n
        for k in _STEMS:
            if len(w) <= k:
                break
            out[w[:k] + "*"] += n
    return out


@dataclass(frozen=True)
class FitParameters:
    """``sample``: labelled documents used at most, half of them toxic; ``features``: words kept at most, by association
    with the label (G squared of at least ``least_g2``, in at least ``least_documents`` of the sample); ``severe_share``: a toxic document
    is of grade 2 if it has at least this share of toxic-leaning features (``leaning`` times likelier in toxic documents) to a word. What leans is
    counted on the half of the sample that the document is not in, so no document grades itself."""

    sample: int = 8000
    features: int = 2048
    least_documents: int = 3
    least_g2: float = 10.83
    leaning: float = 8.0
    severe_share: float = 0.05
    penalty: float = 0.5


@dataclass
class SeverityModel:
    """P(grade > j) = logistic(w.x - t_j) for increasing thresholds t, with the same weights w at each; x is 1 + ln(count) of each word."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, text: str) -> float:
        weights, starts = self.weights, self.starts
        return sum(weights[w] * (1.0 + math.log(n)) for w, n in features_of(" ".join([w for w in _WORD(text.lower()) if w[:3] in starts])).items() if w in weights)

    @cached_property
    def starts(self) -> frozenset[str]:
        """What words that have any feature begin with."""
        return frozenset(w.rstrip("*")[:3] for w in self.weights)

    def above(self, texts: list[str | None]) -> np.ndarray:
        """Row for each text, column for each threshold: the probability of a grade above it."""
        scores = np.array([self.score(t) if t else 0.0 for t in texts])
        return logistic(scores[:, None] - np.array(self.thresholds)[None, :])


#: What is fitted where the labels are all alike: every document has grade 0.
HARMLESS = SeverityModel({}, (50.0, 50.0))


def logistic(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def fit_cumulative_link(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, penalty: float, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the penalised maximum likelihood, by L-BFGS.

    The features come as triples (row, column, value). The first threshold is free and the further ones add exponentials, so
    they stay in order. Grades that don't occur get their thresholds from the penalty alone."""
    n = len(grades)

    def split(p: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([p[n_features : n_features + 1], np.exp(np.clip(p[n_features + 1 :], -30, 30))]))

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        t = split(p)
        z = np.bincount(rows, weights=values * p[columns], minlength=n)
        upper = np.concatenate([t, [np.inf]])[grades]
        lower = np.concatenate([[-np.inf], t])[grades]
        a, b = logistic(upper - z), logistic(lower - z)
        chance = np.maximum(a - b, 1e-12)
        da, db = a * (1 - a), b * (1 - b)
        slope = np.zeros_like(p)
        slope[:n_features] = np.bincount(columns, weights=values * ((da - db) / chance)[rows], minlength=n_features)
        t_slope = np.zeros(n_grades)
        np.add.at(t_slope, grades, -da / chance)
        np.add.at(t_slope, grades - 1, np.where(grades > 0, db / chance, 0.0))
        t_slope = t_slope[: n_grades - 1]
        tail = np.cumsum(t_slope[::-1])[::-1]
        slope[n_features] = tail[0]
        slope[n_features + 1 :] = tail[1:] * np.exp(np.clip(p[n_features + 1 :], -30, 30))
        cost = -np.log(chance).sum() + 0.5 * penalty * (p[:n_features] ** 2).sum() + 0.005 * (p[n_features:] ** 2).sum()
        slope[:n_features] += penalty * p[:n_features]
        slope[n_features:] += 0.01 * p[n_features:]
        return cost, slope

    p = np.zeros(n_features + n_grades - 1)
    cost, slope = loss(p)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, kept = -slope, []
        for s, y in reversed(history):
            a = s @ d / (y @ s)
            kept.append(a)
            d = d - a * y
        if history:
            s, y = history[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(history, reversed(kept), strict=True):
            d = d + s * (a - y @ d / (y @ s))
        fall, size = slope @ d, 1.0 if history else min(1.0, 1.0 / max(1e-9, np.abs(slope).max()))
        while size > 1e-10 and (trial := loss(p + size * d))[0] > cost + 1e-4 * size * fall:
            size /= 2
        if size <= 1e-10:
            break
        s, y = size * d, trial[1] - slope
        done = cost - trial[0] < 1e-8 * abs(cost)
        p, cost, slope = p + s, *trial
        if s @ y > 1e-12:
            history = [*history, (s, y)][-10:]
        if done:
            break
    return p[:n_features], split(p)


def _associations(words: DataFrame, sizes: dict[tuple[int, int], int], fit: FitParameters) -> DataFrame:
    """Words of the sample with G squared of word against label, and for each half whether the other half counts it as toxic-leaning."""
    total = lambda toxic, halves=(0, 1): sum(sizes.get((toxic, h), 0) for h in halves)
    toxic, clean = total(1), total(0)
    seen = lambda toxic, half: F.sum(F.when((F.col("toxic") == toxic) & (F.col("half") == half), 1).otherwise(0)).cast("double")
    count = words.groupBy("word").agg(*(seen(t, h).alias(f"{name}{h}") for t, name in ((1, "a"), (0, "b")) for h in (0, 1)))
    count = count.withColumns({"a": F.col("a0") + F.col("a1"), "b": F.col("b0") + F.col("b1")})
    n = toxic + clean
    part = lambda seen, total, margin: F.when(seen > 0, seen * F.log(seen * n / (F.lit(float(total)) * margin))).otherwise(0.0)
    with_word, without = F.col("a") + F.col("b"), n - (F.col("a") + F.col("b"))
    g2 = 2 * (part(F.col("a"), toxic, with_word) + part(F.col("b"), clean, with_word) + part(toxic - F.col("a"), toxic, without) + part(clean - F.col("b"), clean, without))
    ratio = lambda h: ((F.col(f"a{h}") + 0.5) / (total(1, (h,)) + 1.0)) / ((F.col(f"b{h}") + 0.5) / (total(0, (h,)) + 1.0))
    leans = [(ratio(1 - h) >= fit.leaning).alias(f"leans{h}") for h in (0, 1)]
    return count.where(with_word >= fit.least_documents).select("word", g2.alias("g2"), *leans).where(F.col("g2") >= fit.least_g2).orderBy(F.desc("g2"), "word").limit(fit.features)


def fit_severity(docs: DataFrame, labels: DataFrame, fit: FitParameters = FitParameters(), id_col: str = "doc_id", text_col: str = "text") -> SeverityModel:
    """Fit grades 0 (harmless), 1 (mild) and 2 (severe) to labels ``toxic`` 0 or 1.

    The sample is taken by a hash of the id, so it is the same on every run; a document with several labels counts as toxic if
    one says so; null labels, ids and texts are left out. Word statistics of the sample are aggregated in Spark; the driver
    gets the kept words and the sample's counts of those. The sample is half toxic where it can be; the thresholds are then moved by the
    log odds that this adds, so that probabilities are those of the labelled documents. Without labels of both kinds, or words that tell
    them apart, the model finds every document harmless."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    labelled = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.sample // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    sample = scratch.table("sample", source.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    half = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)).cast("int").alias("half")
    sizes = {(r["toxic"], r["half"]): r["n"] for r in sample.groupBy("toxic", half).agg(F.count("*").alias("n")).collect()}
    sampled = {t: sum(n for (u, _), n in sizes.items() if u == t) for t in (0, 1)}
    if not all(sampled.values()):
        return HARMLESS

    @frees_memory
    def counts(batches):
        for batch in pieces(batches):
            at, word, n = [], [], []
            for k, text in enumerate(batch.column(2)):
                for w, c in features_of(text.as_py()).items():
                    at.append(k)
                    word.append(w)
                    n.append(c)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(word, pa.string()), pa.array(n, pa.int64())], ["doc_id", "toxic", "word", "n"])

    id_type = sample.schema["doc_id"].dataType.simpleString()
    words = sample.select("doc_id", "toxic", "text").mapInArrow(counts, f"doc_id {id_type}, toxic int, word string, n long").withColumn("half", half)
    chosen_words = _associations(words, sizes, fit).toPandas()
    if not len(chosen_words):
        return HARMLESS
    kept = spark.createDataFrame(chosen_words[["word"]].assign(at=range(len(chosen_words))))
    per_document = words.where("word not like '%*'").groupBy("doc_id", "toxic", "half").agg(F.sum("n").alias("length"))
    # As Arrow columns: 16 bytes for each kept feature of a sampled document, a few MB in all.
    triples = words.join(F.broadcast(kept), "word").select("doc_id", F.col("at").cast("int").alias("at"), F.col("n").cast("int").alias("n")).toArrow()
    table = per_document.orderBy("doc_id").toArrow()
    if not len(table):
        return HARMLESS
    rows = np.searchsorted(table.column("doc_id").to_numpy(), triples.column("doc_id").to_numpy())
    columns, n = triples.column("at").to_numpy(), triples.column("n").to_numpy().astype(float)
    halves = table.column("half").to_numpy()
    leans = np.where(halves[rows] == 0, chosen_words["leans0"].to_numpy()[columns], chosen_words["leans1"].to_numpy()[columns])
    share = np.bincount(rows, weights=n * leans, minlength=len(table)) / np.maximum(1, table.column("length").to_numpy())
    toxic = table.column("toxic").to_numpy().astype(np.int64)
    grades = toxic * (1 + (share >= fit.severe_share))
    weights, thresholds = fit_cumulative_link(rows, columns, 1.0 + np.log(n), grades, len(chosen_words), 3, fit.penalty)
    added = math.log(sampled[1] / sampled[0]) - math.log(labelled[1] / labelled[0])
    kept_weights = {w: float(x) for w, x in zip(chosen_words["word"], weights, strict=True) if abs(x) > 1e-6}
    return SeverityModel(kept_weights, tuple(float(t) + added for t in thresholds))


def grade_severity(docs: DataFrame, model: SeverityModel, reject_at: float = REJECT_AT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every document: P(grade >= 1), P(grade >= 2), expected severity, and whether P(grade >= 1) reaches ``reject_at``.

    Null and empty texts score zero on every word; repeated rows give repeated results; long texts are read whole."""
    id_type = docs.schema[id_col].dataType.simpleString()

    @frees_memory
    def run(batches):
        for batch in pieces(batches):
            above = model.above(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above[:, 0]), pa.array(above[:, 1]), pa.array(above.sum(axis=1)), pa.array(above[:, 0] >= reject_at)],
                ["doc_id", "p_mild", "p_severe", "severity", "rejected"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, p_mild double, p_severe double, severity double, rejected boolean")


def drop_toxic(docs: DataFrame, model: SeverityModel, reject_at: float = REJECT_AT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that are not rejected. Null, empty and blank texts score zero and stay wherever a
    document without toxic words does; repeated rows fare alike; an empty table gives no rows; only ``text_col`` is looked at."""
    at = docs.columns.index(text_col)

    @frees_memory
    def run(batches):
        for batch in pieces(batches):
            yield batch.filter(pa.array(model.above(batch.column(at).to_pylist())[:, 0] < reject_at))

    return docs.mapInArrow(run, docs.schema)
