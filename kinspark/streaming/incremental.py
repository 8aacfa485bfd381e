"""Incremental matching: new query entities from a stream meet a stored side of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinspark.config import Blocking
from kinspark.functions.normalize import normalize
from kinspark.operators import blocking


def match_stream(arriving: DataFrame, others: DataFrame, cfg: Blocking, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the candidates (s1_id, cand_id) of each micro-batch of ``arriving`` (the four entity columns) under ``path``.

    ``others`` are normalized rows, best read from a written table; their key rows are made once. A batch writes to a
    folder of its own number, so one that runs again after a failure replaces what it wrote. Empty batches write an empty table."""
    keys = blocking.key_rows(others, cfg).persist()

    def one(batch: DataFrame, number: int) -> None:
        pairs = blocking.candidates(normalize(batch), others, cfg, other_keys=keys)
        pairs.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = arriving.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
