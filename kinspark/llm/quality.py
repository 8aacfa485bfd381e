"""Quality rules: text statistics, and a decision list learned from labelled statistics by sequential covering."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .text import Words, chunks, frees_memory, marked, window_hashes

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_WINDOW = 8

#: Features of the rules: each a ratio of two statistics, so that a rule means the same for short and long texts.
FEATURES = {
    "n_words": ("n_words", None),
    "chars_a_word": ("word_chars", "n_words"),
    "symbols_a_word": ("n_symbols", "n_words"),
    "repeated_word_share": ("n_repeat_words", "n_words"),
    "repeated_line_share": ("n_dup_lines", "n_lines"),
    "words_a_line": ("n_words", "n_lines"),
}


def _repeated_lines(lines: list[str]) -> int:
    with_word = [x for x in lines if x.strip(" \t\n\r\x0b\x0c")]
    return len(with_word) - len(set(with_word))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each whole text: words, code points in words, symbols, repeated lines, words in repeated windows, lines.

    A word counts in ``n_repeat_words`` if some window of eight words that holds it occurs at least twice in the text. Null and
    empty texts have no words and one (empty) line; repeated rows give repeated results. One pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    @frees_memory
    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, text_col):
                n = part.num_rows
                words = Words(data, offsets)
                sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
                first = words.inside & ((data & 0xC0) != 0x80)
                at = window_hashes(words.hashes(), _WINDOW)
                starts = np.flatnonzero(words.document[: len(at)] == words.document[_WINDOW - 1 :]) if len(at) else np.zeros(0, np.int64)
                order = starts[np.lexsort((at[starts], words.document[starts]))] if len(starts) else starts
                same = (at[order[1:]] == at[order[:-1]]) & (words.document[order[1:]] == words.document[order[:-1]])
                twice = np.zeros(len(order), dtype=bool)
                twice[1:] |= same
                twice[:-1] |= same
                hit = order[twice]
                repeat = marked(hit, hit + _WINDOW, len(words.starts))
                lines = [(t or "").split("\n") for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                columns = [words.counts, sums(first), sums(_SYMBOL[data]), np.array([_repeated_lines(x) for x in lines], dtype=np.int64), np.bincount(words.document[repeat], minlength=n), np.array([len(x) for x in lines], dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c.astype(np.int64)) for c in columns)], ["doc_id", *STATISTICS])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)).mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in STATISTICS))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] < self.threshold

    def column(self) -> Column:
        value = feature_column(self.feature)
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self):
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction of thresholds; a text that meets all is rejected."""

    conditions: tuple[Condition, ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for c in self.conditions:
            out &= c.holds(x)
        return out

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self):
        return " and ".join(map(str, self.conditions))


def feature_column(name: str) -> Column:
    over, under = FEATURES[name]
    return F.col(over).cast("double") if under is None else F.coalesce(F.try_divide(F.col(over).cast("double"), F.col(under).cast("double")), F.lit(0.0))


def feature_arrays(stats: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: stats[a].astype(float) if b is None else np.divide(stats[a], stats[b], out=np.zeros(len(stats[a])), where=stats[b] > 0) for k, (a, b) in FEATURES.items()}


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray, now: np.ndarray, rule: tuple[Condition, ...], cuts: int) -> tuple[float, Condition | None, np.ndarray]:
    """The threshold with the largest information gain for the bad texts still covered."""
    p0, n0 = int((now & bad).sum()), int((now & ~bad).sum())
    best, chosen, covered = 0.0, None, now
    for name, values in x.items():
        inside = values[now]
        for t in np.unique(np.quantile(inside, np.linspace(0, 1, cuts + 1), method="nearest")):
            for above in (True, False):
                c = Condition(name, above, float(t))
                then = now & c.holds(x)
                p, n = int((then & bad).sum()), int((then & ~bad).sum())
                if p and p + n < p0 + n0:
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                    if gain > best + 1e-9:
                        best, chosen, covered = gain, c, then
    return best, chosen, covered


def learn_rules(stats: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 12, most_conditions: int = 3, least_precision: float = 0.9, least_cover: int = 5, cuts: int = 64) -> list[Rule]:
    """An ordered list of rules for the bad texts.

    Sequential covering: two thirds of the rows (by position, as the caller has shuffled them) grow a rule, threshold by
    threshold; on the other third its last conditions are pruned while (p - n) / (p + n) doesn't fall. A rule enters the list if its precision over all
    remaining rows is ``least_precision`` and it covers ``least_cover`` bad ones; what it covers is then set aside."""
    x, left, rules = feature_arrays(stats), np.ones(len(bad), dtype=bool), []
    growing = np.arange(len(bad)) % 3 != 2
    while len(rules) < most_rules and (left & bad).any():
        now, conditions = left & growing, ()
        while len(conditions) < most_conditions and (now & bad).any() and (now & ~bad).any():
            _, chosen, now = _best_condition(x, bad, now, conditions, cuts)
            if chosen is None:
                break
            conditions += (chosen,)
        if not conditions:
            break
        held = left & ~growing

        def worth(k: int) -> float:
            hit = held & Rule(conditions[:k]).holds(x)
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - n) / (p + n) if p + n else -1.0

        size = max(range(1, len(conditions) + 1), key=lambda k: (worth(k), -k))
        rule = Rule(conditions[:size])
        hit = left & rule.holds(x)
        p = int((hit & bad).sum())
        if p < least_cover or p < least_precision * int(hit.sum()):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression over the statistics: false where the first rule that holds rejects."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.column(), F.lit(False)).otherwise(out)
    return out


def judge_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of every document with ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated windows. ``kept``: not base_failed, and the
    learned list doesn't reject. The list is learned from at most ``sample`` labelled documents (label column ``quality``, 0
    is bad; the first by a hash of the id), all on the driver; statistics cover every document. Without labels of both kinds the list is empty. Null
    labels are ignored; a document with several labels is used with each."""
    spark = docs.sparkSession
    stats = Scratch(spark, "quality").table("statistics", text_statistics(docs, id_col, text_col))
    chosen = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = chosen.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    rows = stats.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *STATISTICS).limit(sample).toPandas()
    known = {c: rows[c].to_numpy() for c in STATISTICS}
    bad = rows["quality"].to_numpy() == 0
    usual = known["n_words"] >= 20 if len(rows) else np.zeros(0, bool)
    rules = learn_rules({k: v[usual] for k, v in known.items()}, bad[usual]) if bad.any() and not bad.all() else []
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
