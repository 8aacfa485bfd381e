"""Public tokenizer files: the driver reads the file, a broadcast of that fixed size carries it, each worker parses it once."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark import Broadcast
from pyspark.sql import SparkSession

_parsed: dict[tuple[str, str], object] = {}


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file (1 to 2 MB, whatever the corpus)."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def parsed(raw: bytes, kind: str, build) -> object:
    """``build(raw)``, kept for the life of the worker process."""
    key = (kind, hashlib.md5(raw).hexdigest())
    if key not in _parsed:
        _parsed[key] = build(raw)
    return _parsed[key]


def library(raw: bytes):
    """The tokenizers library's object for the file, without truncation or padding."""
    from tokenizers import Tokenizer

    out = Tokenizer.from_str(raw.decode())
    out.no_truncation()
    out.no_padding()
    return out


def ranked(raw: bytes):
    """A rank-table encoder with the vocabulary and special tokens of a byte-level BPE file; ids equal the library's, several times faster."""
    import public_tokenizers
    import tiktoken

    spec = json.loads(raw)
    symbols = byte_symbols()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(symbols[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
