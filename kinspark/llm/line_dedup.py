"""Line deduplication with a suffix array over line numbers, built by distributed prefix doubling; DataFrame operations only.

Every document is a sequence of lines. A rank of depth d orders the suffixes of these sequences by their first d lines, so
suffixes of one rank are an interval of the suffix array whose longest common prefix has d lines or more. From depth d to 2 d
the pair (rank at p, rank at p + d) is ranked anew. A suffix alone in its interval drops out, since no repeat begins there; so
the table shrinks from round to round, and the rounds end when no interval is left.

Then the intervals are walked back down. A suffix lies in its deepest interval with an earlier suffix; from there its common
prefix grows by half the last step each time, where the interval so split still has an earlier suffix. The length found is that of the
longest run of lines that begins there and also starts earlier. Only intervals whose suffixes follow differing lines are
walked: elsewhere the run began a line further up. What is found are the maximal repeated runs, and those long enough are deleted.

Ranks come from a range-partitioned sort of the distinct pairs (a hot pair is one row there), numbered by partition and row. In
the walk an interval is named by its first suffix and its depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .membership import split_by_keys
from .shared import Scratch

_NO_ID = -(2**63)
#: The key of a document, and a place in it. User columns never stand beside these names.
_KEY = ["doc", "copy"]
_PLACE = [*_KEY, "at"]
_WORD = r"[^\x20\x09-\x0D]+"
_MARKS = ("removed", "n_runs", "longest")


def _place() -> Column:
    return F.struct(*_PLACE)


def _numbered_lines(docs: DataFrame) -> DataFrame:
    """(key, at, line, words, one, two, before): lines with a word; ``at`` counts those, ``line`` all lines of the text, from 0.

    ``before`` is a hash of the line before; a first line has one of its own."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("text")))
    lines = F.filter(lines, lambda x: x["text"].rlike(r"[^\x20\x09-\x0D]"))
    hashed = docs.select(*_KEY, F.transform(lines, lambda x: F.struct(x["line"].alias("line"), F.regexp_count(x["text"], F.lit(_WORD)).cast("long").alias("words"), F.xxhash64(x["text"]).alias("one"), F.xxhash64(F.lit(1), x["text"]).alias("two"))).alias("x"))
    before = F.concat(F.array(F.xxhash64(F.lit(2), *_KEY)), F.transform("x", lambda x: x["one"]))
    rows = hashed.where(F.size("x") > 0).select(*_KEY, F.posexplode(F.arrays_zip(F.col("x").alias("x"), F.slice(before, F.lit(1), F.size("x")).alias("before"))).alias("at", "z"))
    return rows.select(*_PLACE, "z.x.*", F.col("z.before").alias("before"))


def _ranked(rows: DataFrame, by: list[str], scratch: Scratch, name: str) -> DataFrame:
    """The suffixes that share their interval: rank in the order of keys, first suffix of the interval, whether that is an earlier
    one, and whether the interval's suffixes follow differing lines."""
    found = rows.groupBy(*by).agg(F.min(_place()).alias("first"), F.max(_place()).alias("last"), (F.min("before") != F.max("before")).alias("starts"))
    found = found.where("first <> last").drop("last")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    intervals = scratch.table(f"{name}-intervals", ordered.withColumn("rank", F.monotonically_increasing_id()))
    known = rows.join(intervals, by)
    out = scratch.table(name, known.select(*_PLACE, "rank", "words", "before", "first", "starts", (_place() != F.col("first")).alias("later")))
    scratch.drop(f"{name}-intervals")
    return out


def _doubled(lines: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Tables of the suffixes that share an interval of depth 1, 2, 4, ...; ``words`` counts those of the first two lines at most."""
    tables, depth = [_ranked(lines, ["one", "two"], scratch, "depth-1")], 1
    while not tables[-1].isEmpty():
        now = tables[-1]
        ahead = now.select(*_KEY, (F.col("at") - depth).alias("at"), F.col("rank").alias("back"), F.col("words").alias("more"))
        pairs = now.select(*_PLACE, "before", "words", F.col("rank").alias("front")).join(ahead, _PLACE)
        words = F.col("words") + F.col("more") if depth == 1 else F.col("words")
        depth *= 2
        tables.append(_ranked(pairs.withColumn("words", words), ["front", "back"], scratch, f"depth-{depth}"))
        scratch.sweep()
    return tables[:-1]


def _extended(rows: DataFrame, ranks: DataFrame, step: int, scratch: Scratch, name: str) -> DataFrame:
    """Split each interval by the next ``step`` lines: suffixes with an earlier one in their part move there, ``step`` deeper.

    The first suffix of a part stays behind, where it stands for all of them, and stands for itself in the part as well."""
    ahead = ranks.select(*_KEY, F.col("at").alias("target"), F.col("rank").alias("back"))
    met = scratch.table(f"{name}-met", rows.withColumn("target", F.col("at") + F.col("depth")).join(ahead, [*_KEY, "target"], "left").drop("target"))
    split = met.where("back is not null").groupBy("first", "depth", "back").agg(F.min(_place()).alias("part"), F.max(_place()).alias("last")).where("part <> last").drop("last")
    moves = F.coalesce(_place() != F.col("part"), F.lit(False))
    moved = met.join(split, ["first", "depth", "back"], "left")
    moved = moved.select(*_PLACE, F.when(moves, F.col("depth") + step).otherwise(F.col("depth")).alias("depth"), F.when(moves, F.col("part")).otherwise(F.col("first")).alias("first"), "words")
    heads = split.select("part.*", (F.col("depth") + step).alias("depth"), F.col("part").alias("first"), F.lit(None).cast("long").alias("words"))
    out = scratch.table(name, moved.unionByName(heads))
    scratch.drop(f"{name}-met")
    return out


def repeated_runs(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The lines of ``docs`` (doc, copy, text), and the maximal runs (doc, copy, at, depth, words) of lines that also start earlier.

    ``depth`` counts the lines of a run; ``words``, for runs of one or two lines, its words. Null and empty texts have no lines;
    rows that agree in doc and copy are one document; an empty table gives no rows."""
    lines = _numbered_lines(docs)
    if not docs.groupBy(*_KEY).count().where("count > 1").isEmpty():
        lines = lines.dropDuplicates(_PLACE)
    lines = scratch.table("lines", lines)
    tables = _doubled(lines, scratch)
    none = F.lit(None).cast("long")
    if not tables:
        return lines, lines.select(*_PLACE, F.lit(1).alias("depth"), "words").limit(0)
    deeper = [t.where("later").select(*_PLACE) for t in tables[1:]]
    # Each suffix in its deepest interval with an earlier suffix; first suffixes in every interval, for others to be compared with.
    nodes = [t.where("starts").join(d, _PLACE, "left_anti") for t, d in zip(tables, deeper, strict=False)] + [tables[-1].where("starts")]
    runs = nodes[0].where("later").select(*_PLACE, F.lit(1).alias("depth"), "words")
    walked = None
    for k in range(len(tables) - 2, -1, -1):
        entering = nodes[k + 1].select(*_PLACE, F.lit(2 ** (k + 1)).alias("depth"), "first", (F.col("words") if k == 0 else none).alias("words"))
        rows = entering if walked is None else walked.unionByName(entering)
        walked = _extended(rows, tables[k], 2**k, scratch, f"walked-{k}")
        scratch.drop(f"walked-{k + 1}")
        scratch.sweep()
    if walked is not None:
        runs = runs.unionByName(walked.where(_place() != F.col("first")).select(*_PLACE, "depth", "words"))
    return lines, scratch.table("runs", runs)


def mark_repeated_lines(docs: DataFrame, least_lines: int = 3, least_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, lines, removed, n_runs, longest): every row of ``docs`` as a struct, its lines, the numbers of the lines to delete,
    how many stretches those make, and the lines of the longest run among them; the last three are null where nothing goes.

    A line is deleted if it lies in a run of lines that also starts earlier (smaller id, or the same document further up; the
    copies may overlap) and the maximal run has ``least_lines`` lines (from 3) or ``least_words`` words. Runs are judged on the input.
    Lines without a word neither interrupt nor belong to a run, and stay.

    A null or empty text has nothing to delete; null ids come before all others; rows that repeat an id are told apart by
    their text, and rows that repeat both get the same result; an empty table gives no rows; no name of a user's column can clash."""
    if least_lines < 3:
        raise ValueError("least_lines must be 3 or more")
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("doc"), F.xxhash64(key, F.col(text_col)).alias("copy"), F.col(text_col).alias("text"))
    scratch = Scratch(docs.sparkSession, "lines")
    lines, runs = repeated_runs(rows.select(*_KEY, "text"), scratch)
    enough = (F.col("depth") >= least_lines) | (F.col("words") >= least_words)
    runs = runs.where(enough)
    covered = runs.select(*_KEY, F.explode(F.sequence("at", F.col("at") + F.col("depth") - 1)).alias("at")).distinct()
    covered = covered.join(lines.select(*_PLACE, "line"), _PLACE)
    marks = covered.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("x"))
    at = F.transform("x", lambda x: x["at"])
    starts = F.filter(F.transform(at, lambda v, i: F.when((i == 0) | (v != F.get(at, i - 1) + 1), 1)), lambda v: v.isNotNull())
    marks = marks.select(*_KEY, F.col("x.line").alias("removed"), F.size(starts).alias("n_runs"))
    marks = scratch.table("marks", marks.join(runs.groupBy(*_KEY).agg(F.max("depth").alias("longest")), _KEY))
    # Most documents have no mark; they stay where they are, the others are shuffled to theirs.
    some, others = split_by_keys(rows, "copy", marks)
    blank = [F.lit(None).cast(marks.schema[c].dataType).alias(c) for c in _MARKS]
    out = some.join(marks, _KEY, "left").unionByName(others.select("*", *blank))
    return out.select("row", F.split("text", "\n", -1).alias("lines"), *_MARKS)


def kept_text(text_col: str = "text") -> Column:
    """The text without its deleted lines, over the columns of ``mark_repeated_lines``."""
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    return F.when(F.col("removed").isNull(), F.col("row")[text_col]).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))


def drop_repeated_lines(docs: DataFrame, least_lines: int = 3, least_words: int = 50, id_col: str = "doc_id", text_col: str = "text", emptied: bool = True) -> DataFrame:
    """All rows and columns of ``docs``, the text without later copies of repeated runs of lines.

    Without ``emptied``, rows that lose every line with a word go. Null, empty and blank texts stay as they are, as do rows that
    repeat nothing; rows that repeat id and text stay each on its own, alike."""
    marked = mark_repeated_lines(docs, least_lines, least_words, id_col, text_col)
    out = marked.select("row", kept_text(text_col).alias("kept"), F.col("removed").isNotNull().alias("changed"))
    if not emptied:
        out = out.where(~(F.col("changed") & ~F.col("kept").rlike(r"[^\x20\x09-\x0D]")))
    return out.select(*((F.col("kept") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns))
