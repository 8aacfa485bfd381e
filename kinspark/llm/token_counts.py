"""Token counts by byte-pair merging with a heap over a linked list of symbols; no token identifiers are produced."""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import frees_memory, utf8
from .vocabulary import byte_symbols, parsed, shipped

#: Pieces whose counts a worker keeps; past that it starts afresh, which costs time and changes nothing else.
KEPT_PIECES = 400_000


class MergeCounter(dict):
    """Counts of pieces under a merge list; as a dictionary it keeps the counts of pieces seen."""

    def __init__(self, raw: bytes):
        import public_tokenizers
        import regex

        spec = json.loads(raw)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        self.first = [0] * 256
        for char, byte in symbols.items():
            self.first[byte] = vocab[char]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for k, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.rank[vocab[a] << 24 | vocab[b]] = k
            self.made.append(vocab[a + b])
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.at_special = regex.compile("|".join(regex.escape(s) for s in self.specials)).split if self.specials else None

    def merged(self, data: bytes) -> int:
        """Symbols left of ``data``: repeatedly the leftmost adjacent pair of lowest rank becomes one symbol.

        The heap holds rank and place as one integer; an entry is stale when the pair now at its place has another rank."""
        n = len(data)
        if n < 2:
            return n
        rank, made = self.rank, self.made
        symbol = [self.first[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 40 | i for i in range(n - 1) if (r := rank.get(symbol[i] << 24 | symbol[i + 1])) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            entry = heapq.heappop(heap)
            r, i = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[i]
            if symbol[i] < 0 or j >= n or rank.get(symbol[i] << 24 | symbol[j]) != r:
                continue
            symbol[i], symbol[j] = made[r], -1
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (s := rank.get(symbol[i] << 24 | symbol[k])) is not None:
                    heapq.heappush(heap, s << 40 | i)
            h = before[i]
            if h >= 0 and (s := rank.get(symbol[h] << 24 | symbol[i])) is not None:
                heapq.heappush(heap, s << 40 | h)
        return n - merges

    def __missing__(self, piece: str) -> int:
        count = self.merged(piece.encode())
        if len(piece) <= 64:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = count
        return count

    def count(self, text: str) -> int:
        """Tokens of a text; the strings of special tokens count one each, as the library has it by default."""
        parts = self.at_special(text) if self.at_special else [text]
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(part))) for part in parts)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed ``limit``.

    ``vocabulary`` is the path of a byte-level BPE file. Null and empty texts have 0 bytes and 0 tokens; repeated rows give
    repeated results; a text of any length is counted whole. One pass over the rows, no shuffle."""
    raw = shipped(docs.sparkSession, vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()

    @frees_memory
    def run(batches):
        counter = parsed(raw.value, "merges", MergeCounter)
        for batch in batches:
            tokens = [counter.count(t) if t else 0 for t in (x.as_py() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(utf8(batch.column(1))[1])), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
