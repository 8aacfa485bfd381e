"""BPE encoding and decoding through a table of distinct words.

Words are split inside Spark tasks and gathered by block (a stretch of one task's documents). The distinct words of a block are
dealt into buckets by hash; a row (block, bucket, words) goes to the task that owns the bucket, which encodes each distinct word
once and sends ids back to the block. The block's positions are numbers of its distinct words, compressed; they put ids in place.
So each word travels once for each block and the commonest word is no heavier than others; what travels is smaller than the text."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from .text import frees_memory
from .vocabulary import library, parsed, shipped

#: Characters of text in a block, more only where one document is longer.
BLOCK_CHARS = 16 << 20
#: White space as the vocabulary's normalizer has it (the Unicode property); str.split() takes U+001C to U+001F besides.
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SPLIT_ONLY = re.compile("[\x1c-\x1f]")
#: Rows of words between a block and its buckets, and the row of the block itself.
_ROW = [("block", pa.string()), ("bucket", pa.int32()), ("documents", pa.binary()), ("codes", pa.binary()), ("data", pa.binary())]
_ROW_DDL = "block string, bucket int, documents binary, codes binary, data binary"
#: Words handed to the tokenizers library at a time.
_WORDS_AT_ONCE = 1_000


def split_words(text: str) -> list[str]:
    """Words between white space. Normalization and pre-tokenization never reach across it, so words are encoded apart."""
    if _SPLIT_ONLY.search(text):
        return [w for w in _WHITE.split(text) if w]
    return text.split()


def _pack(x: np.ndarray) -> bytes:
    """Non-negative integers with 7 bits a byte, least first, the high bit set where more follow."""
    x = x.astype(np.uint64)
    if not len(x) or x.max() < 128:
        return x.astype(np.uint8).tobytes()
    width = np.ones(len(x), dtype=np.int64)
    for k in range(1, 9):
        width += x >= np.uint64(1 << 7 * k)
    ends = np.cumsum(width)
    out = np.zeros(ends[-1], dtype=np.uint8)
    at = ends - width
    for k in range(int(width.max())):
        has = width > k
        more = np.where(width[has] > k + 1, 0x80, 0).astype(np.uint8)
        out[at[has] + k] = ((x[has] >> np.uint64(7 * k)) & np.uint64(0x7F)).astype(np.uint8) | more
    return out.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, dtype=np.uint8)
    last = data < 0x80
    if last.all():
        return data.astype(np.int64)
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = (np.arange(len(data)) - np.repeat(starts, ends - starts + 1)) * 7
    return np.add.reduceat((data & 0x7F).astype(np.int64) << shift, starts)


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _expand(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _block_rows(name: str, ids: pa.Array, counts: list[int], codes: dict[str, int], words: list[np.ndarray], n_buckets: int) -> Iterator[dict]:
    """The row of a block (documents, numbers of their words, bucket of each distinct word) and a row for each of its buckets.

    Distinct words are numbered from the most frequent one, so that most numbers are short."""
    flat = np.concatenate(words) if words else np.zeros(0, np.int32)
    distinct = list(codes)
    order = np.argsort(-np.bincount(flat, minlength=len(distinct)), kind="stable")
    number = np.empty(len(distinct), dtype=np.int32)
    number[order] = np.arange(len(distinct), dtype=np.int32)
    distinct = [distinct[k] for k in order.tolist()]
    data = [w.encode() for w in distinct]
    bucket = np.array([zlib.crc32(w) for w in data], dtype=np.int64) % n_buckets
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("doc_id", ids.type), ("n", pa.int64())]), options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.record_batch([ids, pa.array(counts, pa.int64())], ["doc_id", "n"]))
    digest = zlib.crc32(b"\n".join(data))
    block = f"{name}-{digest:08x}"  # a task that runs again on rows in another order makes other blocks, never mixed ones
    yield {"block": block, "bucket": digest % n_buckets, "documents": sink.getvalue().to_pybytes(), "codes": _squeeze(_pack(number[flat])), "data": _squeeze(_pack(bucket))}
    by_bucket = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=1)).tolist()
    at = 0
    for k, end in enumerate(ends):
        if end > at:
            yield {"block": block, "bucket": k, "documents": None, "codes": None, "data": _squeeze(b"\n".join([data[i] for i in by_bucket[at:end].tolist()]))}
        at = end


def _spread(batches: Iterator[pa.RecordBatch], block_chars: int, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """The rows of blocks of at least one document and, but for that, at most ``block_chars`` characters."""
    from pyspark import TaskContext

    partition = TaskContext.get().partitionId()
    schema = pa.schema(_ROW)
    made, chars = 0, 0
    ids, counts, codes, words = [], [], defaultdict(count().__next__), []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(list(_block_rows(f"{partition}-{made}", pa.array(ids, id_type), counts, codes, words, n_buckets)), schema)

    for batch in batches:
        id_type = batch.schema.field(0).type
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py() or ""
            if ids and chars + len(text) > block_chars:
                yield rows()
                made += 1
                ids, counts, codes, words, chars = [], [], defaultdict(count().__next__), [], 0
            found = split_words(text)
            words.append(np.fromiter(map(codes.__getitem__, found), dtype=np.int32, count=len(found)))
            ids.append(doc_id.as_py())
            counts.append(len(found))
            chars += len(text)
    if ids:
        yield rows()


def _ids_of_words(tokenizer, words: list[str]) -> list[tuple[int, ...]]:
    """Ids of each word. ASCII words go to the library many at a time, a space apart: normalizers leave their lengths alone, so
    where a token starts tells its word. Other words go one by one."""
    plain, other = [w for w in words if w.isascii()], [w for w in words if not w.isascii()]
    out: dict[str, tuple[int, ...]] = {}
    for a in range(0, len(plain), _WORDS_AT_ONCE):
        some = plain[a : a + _WORDS_AT_ONCE]
        code = tokenizer.encode(" ".join(some), add_special_tokens=False)
        ids, places = code.ids, np.array([start for start, _ in code.offsets], dtype=np.int64)
        cuts = np.searchsorted(places, np.cumsum([0, *(len(w) + 1 for w in some)])).tolist()
        out.update((w, tuple(ids[x:y])) for w, x, y in zip(some, cuts[:-1], cuts[1:], strict=True))
    for a in range(0, len(other), _WORDS_AT_ONCE):
        some = other[a : a + _WORDS_AT_ONCE]
        out.update((w, tuple(code.ids)) for w, code in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True))
    return [out[w] for w in words]


def _encode(batches: Iterator[pa.RecordBatch], raw: bytes) -> Iterator[pa.RecordBatch]:
    """Replace the words of a bucket by how many ids each has, and the ids; a word of several blocks is encoded once."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the cores are Spark's to share out
    tokenizer = parsed(raw, "library", library)
    seen: dict[str, tuple[int, ...]] = {}

    def ids_of(data: bytes) -> bytes:
        words = _expand(data).decode().split("\n")
        new = [w for w in words if w not in seen]
        seen.update(zip(new, _ids_of_words(tokenizer, new), strict=True))
        found = [seen[w] for w in words]
        flat = [len(words), *map(len, found)]
        for ids in found:
            flat += ids
        return _squeeze(_pack(np.array(flat, dtype=np.int64)))

    for batch in batches:
        data = [d if known else ids_of(d) for known, d in zip(batch.column(2).is_valid().to_pylist(), batch.column(4).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(data, pa.binary())], schema=pa.schema(_ROW))


def _assemble(table: pa.Table) -> tuple[pa.Table, list[list[int]], np.ndarray]:
    """The documents of a block with their word counts, the ids of each distinct word, and the numbers of all words in order."""
    rows = table.sort_by("bucket").to_pylist()
    (own,) = [r for r in rows if r["documents"] is not None]
    with pa.ipc.open_stream(own["documents"]) as stream:
        documents = stream.read_all()
    order = np.argsort(_unpack(_expand(own["data"])), kind="stable").tolist()
    ids: list[list[int]] = []
    for row in rows:
        if row["documents"] is None:
            flat = _unpack(_expand(row["data"]))
            n = int(flat[0])
            ends = np.cumsum(flat[: n + 1]).tolist()  # the first number counts the words: ends also skip their lengths but one
            flat = flat[1:].tolist()
            ids += [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    if len(ids) != len(order):
        raise RuntimeError(f"block {own['block']} has {len(order)} distinct words and the ids of {len(ids)}")
    numbered: list[list[int]] = [[]] * len(ids)
    for k, x in zip(order, ids, strict=True):
        numbered[k] = x
    return documents, numbered, _unpack(_expand(own["codes"]))


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks with their positions and, by bucket, the ids of their distinct words; the input of ``documents``.

    One shuffle, by bucket of words; there are four buckets for each shuffle partition. ``vocabulary`` is the path of a tokenizer
    file whose words end at white space."""
    spark = docs.sparkSession
    raw = shipped(spark, vocabulary)
    n_buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = docs.select(id_col, text_col).mapInArrow(frees_memory(lambda batches: _spread(batches, block_chars, n_buckets)), _ROW_DDL)
    return spread.repartition("bucket").mapInArrow(frees_memory(lambda batches: _encode(batches, raw.value)), _ROW_DDL)


def documents(encoded: DataFrame, spark: SparkSession, vocabulary: str, id_type: str = "bigint", texts: bool = False) -> DataFrame:
    """Put ids back by position and decode them: one row for each document.

    Decoding joins ids with the vocabulary's table of pieces (its size is that of the file, so each task holds it) and puts a
    space between pieces where the file names no decoder. With ``texts`` the row also holds the ids and the decoded text."""
    raw = shipped(spark, vocabulary)
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if texts else "")

    def run(table: pa.Table) -> pa.Table:
        tokenizer = parsed(raw.value, "library", library)
        if tokenizer.decoder is not None:
            raise ValueError("only vocabularies without a decoder of their own are decoded here")
        pieces = parsed(raw.value, "pieces", lambda _: [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))])
        found, each, places = _assemble(table)
        sizes = [len(i) for i in each]
        plain = [" ".join(map(str, i)).encode() for i in each]
        shown = [" ".join([pieces[x] for x in i]).encode() for i in each]
        out: list[list] = [[] for _ in range(6)]
        at = 0
        for doc_id, n in zip(found.column("doc_id").to_pylist(), found.column("n").to_pylist(), strict=True):
            some = [k for k in places[at : at + n].tolist() if sizes[k]]
            at += n
            ids, text = b" ".join([plain[k] for k in some]), b" ".join([shown[k] for k in some])
            out[0].append(doc_id)
            out[1].append(sum([sizes[k] for k in some]))
            out[2].append(hashlib.sha256(ids).hexdigest())
            out[3].append(hashlib.sha256(text).hexdigest())
            if texts:
                out[4].append([int(x) for x in ids.split()])
                out[5].append(text.decode())
        columns = [pa.array(out[0], id_arrow), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if texts:
            columns += [pa.array(out[4], pa.list_(pa.int32())), pa.array(out[5], pa.string())]
            names += ["ids", "decoded"]
        return pa.table(columns, names)

    id_arrow = to_arrow_type(_parse_datatype_string(id_type))
    return encoded.groupBy("block").applyInArrow(run, schema)


def encode_and_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", texts: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Tokens of every whole text as the tokenizers library gives them without special tokens added, and their decoded text.

    Null, empty and blank texts have no tokens and decode to the empty text; repeated rows give repeated results; ids of any
    type are passed through; a very long document makes a block of its own."""
    encoded = encode(docs, vocabulary, id_col, text_col, block_chars)
    return documents(encoded, docs.sparkSession, vocabulary, docs.schema[id_col].dataType.simpleString(), texts)
