"""Best-fit packing by the sum-of-squares rule: tokenize, cut into pieces, place pieces into sequences of a fixed length."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import Scratch
from .text import frees_memory
from .vocabulary import parsed, ranked, shipped

#: Pieces that one task packs, at most about; a share of its sequences that is bounded by the number of gaps stays open.
PIECES_A_TASK = 50_000
_NO_ROOM = np.iinfo(np.int64).max


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, placed in the order given.

    N(g) is the number of open bins with residual gap g (0 < g < capacity). A piece goes into the open bin that makes the sum
    of N(g) squared smallest, ties to the tightest; a new bin is opened where none has room. (The online rule also weighs a new
    bin against the open ones; with all lengths known and long ones first that only costs sequences.)"""
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), 0
    for k, size in enumerate(lengths.tolist()):
        at, gap = -1, capacity
        if size < capacity:
            cost = 1 - 2 * count[size:capacity]
            cost[1:] += 2 * count[1 : capacity - size] + 1
            cost[count[size:capacity] == 0] = _NO_ROOM
            best = int(cost.argmin())
            if cost[best] != _NO_ROOM:
                gap = size + best
                at = open_bins[gap].pop()
                count[gap] -= 1
        if at < 0:
            at, made = made, made + 1
        bins[k], offsets[k] = at, capacity - gap
        if gap > size:
            open_bins[gap - size].append(at)
            count[gap - size] += 1
    return bins, offsets


def fewest(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum-of-squares packing, long pieces first.

    Long pieces open the bins, short ones then fill the gaps. Pieces of equal length are alike, so the result depends on the
    multiset of lengths alone up to the names of equal pieces."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    bins[order], offsets[order] = sum_of_squares(lengths[order], capacity)
    return bins, offsets


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: its token ids and ``end_id``, cut only where longer than ``capacity``, the first piece then the shorter one.

    Null and empty texts give one piece, the end id alone; repeated rows give repeated pieces; an empty table gives no rows; texts
    of any length are tokenized whole; only ``id_col`` and ``text_col`` are looked at."""
    raw = shipped(docs.sparkSession, vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()

    @frees_memory
    def run(batches):
        encoder = parsed(raw.value, "ranked", ranked)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = np.append(encoder.encode_to_numpy(text.as_py() or "", allowed_special="all"), end_id).astype("<u4")
                n = -(-len(ids) // capacity)
                cuts = [0, *range(len(ids) - capacity * (n - 1), len(ids) + 1, capacity)]
                for p in range(n):
                    row.append(k)
                    piece.append(p)
                    start.append(cuts[p])
                    length.append(cuts[p + 1] - cuts[p])
                    crc.append(zlib.crc32(ids[cuts[p] : cuts[p + 1]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, vocabulary: str, capacity: int, id_col: str = "doc_id", text_col: str = "text", pieces_a_task: int = PIECES_A_TASK) -> DataFrame:
    """One row for each piece with its sequence and its offset there; offsets of a sequence are gapless from 0.

    The pieces (numbers only, a few hundredths of the text) are written once. They are then dealt round-robin, so no key can be
    hot, to tasks of about ``pieces_a_task`` pieces; each packs its own by the sum-of-squares rule. Sequence numbers are the
    task's number and a count within it. Null and empty texts are one piece holding only the end id; repeated rows are packed
    each on its own; a text of any length is tokenized whole."""
    spark = docs.sparkSession
    pieces = Scratch(spark, "packing").table("pieces", token_pieces(docs, vocabulary, capacity, 0, id_col, text_col))
    tasks = max(1, -(-pieces.count() // pieces_a_task))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    @frees_memory
    def run(batches):
        from pyspark import TaskContext

        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        bins, offsets = fewest(table.column("length").to_numpy(), capacity)
        numbers = (TaskContext.get().partitionId() << 33) + bins
        yield from table.append_column("sequence_id", pa.array(numbers)).append_column("offset", pa.array(offsets)).combine_chunks().to_batches(20_000)

    return pieces.repartition(tasks).mapInArrow(run, f"{schema}, sequence_id long, offset long")
