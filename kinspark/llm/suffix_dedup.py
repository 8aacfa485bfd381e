"""Byte-level deduplication: remove what a string of ``length`` bytes covers that also starts earlier.

Blockwise construction of a suffix array, one bucket of suffixes at a time. The suffixes of the corpus are dealt into buckets by
content: the anchor of a window of ``length`` bytes is the place of the least hash among the ``GRAM``-byte strings in it, so
equal windows have equal anchors at equal offsets and meet in the bucket of the anchor's string. Windows that share an anchor
occurrence form one stretch, their context. A bucket whose string occurs once is done. In the others contexts that are equal
byte for byte are one; the suffixes of the rest are sorted block by block (``sorted_suffixes``), long ties by the precomputed
ranks of a difference-cover sample, and neighbours that agree in ``length`` bytes, compared byte for byte, form a class, whose
earliest member stays.

Memory: a task sorts about ``PORTION`` bytes of contexts at a time, buckets whole. A bucket with more than ``CROWD`` contexts is
first dealt out by a salt, and equal contexts of a part become one; if it is still crowded, its windows are dealt into two
buckets by a longer string that they have in common, and so on down to single windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .text import chunks, frees_memory, mix

#: Bytes of the strings that anchor windows.
GRAM = 32
#: Contexts of a bucket that go to one task as they are.
CROWD = 8_192
#: Bytes of contexts that a task sorts at a time, more only where one bucket is larger.
PORTION = 3 << 20
#: Bytes of text whose anchors are found at a time.
SLICE = 1 << 20
#: A difference cover modulo 7: the differences of its members give every residue.
PERIOD, COVER = 7, (0, 1, 3)
#: The least shift that brings two residues into the cover.
_SHIFT = np.array([[next(c for c in range(PERIOD) if (r + c) % PERIOD in COVER and (s + c) % PERIOD in COVER) for s in range(PERIOD)] for r in range(PERIOD)])
_NO_ID = -(2**63)
_MIXERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: Bits of a place within a slice, below the hash that orders anchors; the same for every text.
_PLACE_BITS = np.uint64(24)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place. It only chooses anchors and buckets; what meets is compared byte for byte."""
    n = len(data) - GRAM + 1
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    words = np.empty(len(data), dtype=np.uint64)
    for k in range(8):
        part = words[k::8]
        part[:] = padded[k : k + 8 * len(part)].view("<u8")
    out = words[:n] * _MIXERS[0]
    for k in range(1, GRAM // 8):
        out += words[8 * k : 8 * k + n] * _MIXERS[k]
        out ^= out >> np.uint64(29)
    return out * _MIXERS[1]


def _slice_anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, reach = len(data) - GRAM + 1, length - GRAM + 1
    if n < reach:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    hashes = _gram_hashes(data)
    key = hashes >> _PLACE_BITS << _PLACE_BITS | np.arange(n, dtype=np.uint64)
    # Least key of every ``reach`` neighbours: the least to the end of a block and that from the start of the next.
    blocks = -(-n // reach)
    padded = np.full(blocks * reach, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    grid = padded.reshape(blocks, reach)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - reach + 1
    owner = (np.minimum(back[:count], ahead[reach - 1 : reach - 1 + count]) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    whole = np.ones(count, dtype=bool)
    for end in offsets[1:-1]:
        whole[max(0, end - length + 1) : end] = False
    starts = np.flatnonzero(whole)
    owner = owner[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    place = owner[first]
    return place, starts[first], starts[last], mix(hashes[place]).view(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor occurrences in some documents: place, first and last start of the windows they own, and the hash of their string.

    A document longer than ``SLICE`` is cut into slices that overlap by less than a window; each window lies in one of them."""
    if len(data) <= 2 * SLICE or len(offsets) > 2:
        return _slice_anchors(data, offsets, length)
    parts = []
    for a in range(0, len(data) - length + 1, SLICE):
        piece = data[a : a + SLICE + length - 1]
        place, first, last, gram = _slice_anchors(piece, np.array([0, len(piece)]), length)
        parts.append((place + a, first + a, last + a, gram))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _sample_ranks(data: np.ndarray, padded: np.ndarray, length: int) -> np.ndarray:
    """Ranks (from 1) of the suffixes at the places whose residue is in the cover, by ``length`` bytes and more; 0 elsewhere.

    Names of PERIOD bytes first, then pairs of names in doubling strides."""
    sample = np.flatnonzero(np.isin(np.arange(len(data) + PERIOD) % PERIOD, COVER))
    rank = np.zeros(len(data) + 2 * PERIOD, dtype=np.int64)
    names, span = (_word(padded, sample) >> np.uint64(8)).astype(np.int64), PERIOD
    while True:
        order = np.argsort(names, kind="stable")
        found = names[order]
        ranked = np.cumsum(np.concatenate([[1], found[1:] != found[:-1]])) if len(found) else found
        named = np.empty(len(sample), dtype=np.int64)
        named[order] = ranked
        rank[sample] = named
        if span >= length or len(sample) == 0 or ranked[-1] == len(sample):
            return rank
        names = named * np.int64(len(sample) + 2) + rank[np.minimum(sample + span, len(rank) - 1)]
        span *= 2


def sorted_suffixes(data: np.ndarray, places: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Blocks of ``places`` in the order of the suffixes there, to ``length`` bytes; a block has the suffixes of one leading byte.

    A block is sorted by its first PERIOD bytes. Suffixes that tie there are compared by the ranks of the cover sample at the
    least shift that brings both into the cover: each suffix counts the smaller ones of every residue, and the sum is its place.
    Besides the ranks (three in seven bytes) only one block is in memory."""
    padded = np.concatenate([data, np.zeros(2 * PERIOD + 16, dtype=np.uint8)])
    rank = _sample_ranks(data, padded, length)
    top = np.int64(rank.max(initial=0) + 1)
    lead = data[places]
    by_lead = np.argsort(lead, kind="stable")
    edges = np.flatnonzero(np.diff(lead[by_lead].astype(np.int64), prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(places)), strict=True):
        block = places[by_lead[a:b]]
        _, group = np.unique(_word(padded, block) >> np.uint64(8), return_inverse=True)
        group = group.astype(np.int64) * top
        members = [np.flatnonzero(block % PERIOD == r) for r in range(PERIOD)]
        smaller = np.zeros(len(block), dtype=np.int64)
        for r in range(PERIOD):
            for s in range(PERIOD):
                if len(members[r]) and len(members[s]):
                    shift = _SHIFT[r, s]
                    others = np.sort(group[members[s]] + rank[block[members[s]] + shift])
                    smaller[members[r]] += np.searchsorted(others, group[members[r]] + rank[block[members[r]] + shift])
        yield block[np.argsort(smaller, kind="stable")]


def _word(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a big-endian number, so that numbers compare as bytes do."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[at + k]
    return out


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` bytes agree, compared byte for byte."""
    out = np.zeros(len(a), dtype=bool)
    window = np.lib.stride_tricks.sliding_window_view(data, length)
    for k in range(0, len(a), 1 << 15):
        out[k : k + (1 << 15)] = (window[a[k : k + (1 << 15)]] == window[b[k : k + (1 << 15)]]).all(axis=1)
    return out


def later_windows(contexts: pa.BinaryArray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of contexts that occur earlier: context and start within it. ``order`` has the rank of each context's place in the corpus."""
    contexts = contexts.cast(pa.large_binary())
    ends = np.frombuffer(contexts.buffers()[1], dtype=np.int64)[contexts.offset : contexts.offset + len(contexts) + 1]
    data = np.frombuffer(contexts.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    windows = np.maximum(0, np.diff(ends) - length + 1)
    context = np.repeat(np.arange(len(contexts), dtype=np.int32), windows)
    start = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    whose = np.full(len(data) + 1, -1, dtype=np.int32)
    whose[ends[context] + start] = context
    out_context, out_start = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for block in sorted_suffixes(data, ends[context] + start, length):
        same = np.zeros(len(block), dtype=bool)
        if len(block) > 1:
            near = np.flatnonzero((data[block[1:] + length - 1] == data[block[:-1] + length - 1]) & (data[block[1:] + length // 2] == data[block[:-1] + length // 2])) + 1
            same[near] = _equal(data, block[near], block[near - 1], length)
        name = np.cumsum(~same)
        own = whose[block]
        by = np.lexsort((block, order[own], name))
        first = np.ones(len(by), dtype=bool)
        first[1:] = name[by[1:]] != name[by[:-1]]
        later = by[~first]
        out_context.append(own[later])
        out_start.append(block[later] - ends[own[later]])
    return np.concatenate(out_context), np.concatenate(out_start)


def _intervals(context: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows of a context merged: context, from, to."""
    by = np.lexsort((start, context))
    context, start = context[by], start[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = (context[1:] != context[:-1]) | (start[1:] > start[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(by)) - 1
    return (context[first], start[first], start[last] + length) if len(by) else (context, start, start)


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, places: bool) -> Iterator[pa.RecordBatch]:
    """Anchors of whole texts: their string's hash; with ``places`` the document and the context too, packed into one number."""
    for batch in batches:
        for part, data, offsets in chunks(batch, "text", SLICE):
            place, first, last, gram = anchors(data, offsets, length)
            if not places:
                yield pa.RecordBatch.from_arrays([pa.array(gram)], ["gram"])
                continue
            document = np.searchsorted(offsets, place, side="right") - 1
            which = pa.array(document)
            packed = place - offsets[document] << 16 | place - first << 8 | place - last
            yield pa.RecordBatch.from_arrays([pa.array(gram), part.column(0).take(which), part.column(1).take(which), pa.array(packed)], ["gram", "id", "copy", "packed"])


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each context, cut out of its document: key, n, id, copy, first, hi, lo, bytes."""
    for batch in batches:
        for k in range(batch.num_rows):
            raw = np.frombuffer(batch.column(2)[k].as_py().encode(), dtype=np.uint8)
            found = batch.column(3)[k].values
            gram, n, packed = (found.field(c).to_numpy() for c in ("gram", "n", "packed"))
            for a in range(0, len(gram), 1 << 14):
                code = packed[a : a + (1 << 14)]
                hi, lo = code >> 8 & 0xFF, code & 0xFF
                first = (code >> 16) - hi
                size = hi - lo + length
                ends = np.concatenate([[0], np.cumsum(size)])
                cut = raw[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
                body = pa.Array.from_buffers(pa.binary(), len(code), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(cut)])
                one = lambda c: pa.array(np.full(len(code), batch.column(c)[k].as_py(), dtype=np.int64))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(gram[a : a + (1 << 14)]), pa.array(n[a : a + (1 << 14)]), one(0), one(1), pa.array(first), pa.array(hi.astype(np.int32)), pa.array(lo.astype(np.int32)), body], _CONTEXT)


_CONTEXT = ["key", "n", "id", "copy", "first", "hi", "lo", "bytes"]
_CONTEXT_DDL = "key long, n long, id long, copy long, first long, hi int, lo int, bytes binary"


def _portions(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Rows that come sorted by ``by``, in tables of about ``PORTION`` bytes that keep equal values together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(by).to_numpy()
        if size >= PORTION:
            # A portion ends where the first value after it begins.
            last = held[-1].column(by)[-1].as_py()
            cut = int(np.searchsorted(keys != last, True)) if keys[-1] != last else len(keys)
            held.append(batch.slice(0, cut))
            if cut < len(keys):
                yield pa.Table.from_batches(held)
                held, size = [], 0
                batch = batch.slice(cut)
            else:
                size += batch.nbytes
                continue
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _distinct(table: pa.Table, group: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rank of each row's place; and the rows that are the first of equal bytes in their ``group``, and the other rows."""
    order = np.empty(len(table), dtype=np.int64)
    order[np.lexsort(tuple(table.column(c).to_numpy() for c in ("first", "copy", "id")))] = np.arange(len(table))
    code = pc.dictionary_encode(table.column("bytes").combine_chunks()).indices.to_numpy()
    key = table.column(group).to_numpy()
    by = np.lexsort((order, code, key))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (code[by[1:]] != code[by[:-1]]) | (key[by[1:]] != key[by[:-1]])
    return order, np.sort(by[new]), by[~new]


def _spans(table: pa.Table, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Spans of documents from places within contexts."""
    i, c, first = (table.column(x).to_numpy()[rows] for x in ("id", "copy", "first"))
    return [pa.array(i), pa.array(c), pa.array(first + low), pa.array(first + high)]


def _lengths(table: pa.Table) -> np.ndarray:
    return pc.binary_length(table.column("bytes")).to_numpy().astype(np.int64)


def _dealt_part(batches: Iterator[pa.RecordBatch], length: int, crowd: int) -> Iterator[pa.RecordBatch]:
    """Spans (first to end) of a task's buckets that occur earlier; rows come sorted by part.

    A whole bucket is sorted. A part of a crowded one gives one row (its end is -1) for equal contexts, the others as spans."""
    kind = {"key": pa.int64(), "id": pa.int64(), "copy": pa.int64(), "first": pa.int64(), "hi": pa.int32(), "lo": pa.int32(), "bytes": pa.binary(), "a": pa.int32(), "b": pa.int32(), "end": pa.int64()}

    def spans(i: pa.Array, c: pa.Array, low: pa.Array, high: pa.Array) -> pa.RecordBatch:
        found = {"id": i, "copy": c, "first": low, "end": high}
        return pa.RecordBatch.from_arrays([found[x] if x in found else pa.nulls(len(i), t) for x, t in kind.items()], list(kind))

    for table in _portions(batches, "part"):
        order, kept, later = _distinct(table, "part")
        if len(later):
            yield spans(*_spans(table, later, np.zeros(len(later), np.int64), _lengths(table)[later]))
        crowded = table.column("n").to_numpy()[kept] > crowd
        if crowded.any():
            left = table.take(pa.array(kept[crowded])).append_column("end", pa.array(np.full(int(crowded.sum()), -1)))
            yield from left.select(list(kind)).cast(pa.schema(list(kind.items()))).combine_chunks().to_batches()
        kept = kept[~crowded]
        # A bucket with one distinct context is done.
        _, bucket, n = np.unique(table.column("part").to_numpy()[kept], return_inverse=True, return_counts=True)
        kept = kept[n[bucket] > 1]
        if len(kept):
            some = table.take(pa.array(kept))
            context, start = later_windows(some.column("bytes").combine_chunks(), order[kept], length)
            context, low, high = _intervals(context, start, length)
            yield spans(*_spans(some, context, low, high))


def _dealt_spans(rows: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """The spans of all buckets. ``rows`` has the contexts with n, the size of their bucket.

    Round by round: whole buckets are sorted, crowded ones dealt out by a salt to parts of about CROWD rows. What is left of
    the parts is counted anew; buckets still crowded are halved. There ``a`` and ``b`` bound how far before the anchor the windows of a
    bucket start. All its windows hold the bytes from the anchor less a to the anchor less b plus length; halving the range of
    starts makes that string longer, until it is the window."""
    salt = F.pmod(F.xxhash64("id", "copy", "first", "n"), F.ceil(F.col("n") / F.lit(CROWD)).cast("long"))
    part = F.when(F.col("n") <= CROWD, F.col("key")).otherwise(F.xxhash64("key", salt)).alias("part")
    columns, spans, k = [*_CONTEXT, "a", "b"], None, 0
    rows, crowd = rows.withColumns({"a": F.lit(0), "b": F.lit(length - GRAM)}), CROWD
    schema = "key long, id long, copy long, first long, hi int, lo int, bytes binary, a int, b int, end long"
    while True:
        dealt = rows.select(*columns, part).repartition("part").sortWithinPartitions("part")
        found = scratch.table(f"dealt-{k}", dealt.mapInArrow(frees_memory(lambda b: _dealt_part(b, length, crowd)), schema))
        more = found.where("end >= 0").select("id", "copy", F.col("first").alias("from"), F.col("end").alias("to"))
        spans = more if spans is None else spans.unionByName(more)
        left = found.where("end < 0").drop("end")
        if left.isEmpty():
            return spans
        left = scratch.table(f"left-{k}", left.join(left.groupBy("key").agg(F.count("*").alias("n")), "key").select(columns))
        rows = left.where(F.col("n") <= CROWD).unionByName(_halved(left.where(F.col("n") > CROWD), length))
        k += 1


def _halved(rows: DataFrame, length: int) -> DataFrame:
    """The rows in the two halves of their ranges of starts, keyed by what the windows there have in common, counted anew."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    half = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(F.array(F.struct(F.col("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("b"))))
    out = rows.withColumn("half", F.explode(half)).withColumns({"a": F.col("half.a"), "b": F.col("half.b")}).where("hi >= a and lo <= b")
    common = F.substring("bytes", F.col("hi") - F.col("a") + 1, F.lit(length) - (F.col("b") - F.col("a")))
    low, high = F.greatest("lo", "a"), F.least("hi", "b")
    cut = F.substring("bytes", F.col("hi") - high + 1, high - low + F.lit(length))
    out = out.select(F.xxhash64("key", "a", "b", common).alias("key"), "id", "copy", (F.col("first") + F.col("hi") - high).alias("first"), high.alias("hi"), low.alias("lo"), cut.alias("bytes"), "a", "b")
    return out.join(out.groupBy("key").agg(F.count("*").alias("n")), "key").select(*_CONTEXT, "a", "b")


def repeated_spans(docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(id, copy, from, to): byte spans covered by strings of ``length`` bytes that also start earlier; spans may overlap.

    ``docs`` has id, copy and text. Null and empty texts and those under ``length`` bytes have no spans; rows that agree in id and
    copy are one document; an empty table gives no rows. ``length`` is from 39 to 287, so that a context fits its packed number."""
    if not GRAM + PERIOD <= length <= GRAM + 255:
        raise ValueError(f"length must be from {GRAM + PERIOD} to {GRAM + 255}")
    grams = docs.select("id", "copy", "text").mapInArrow(frees_memory(lambda b: _anchor_rows(b, length, False)), "gram long")
    repeated = scratch.table("repeated", grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"))
    scratch.sweep()
    found = docs.select("id", "copy", "text").mapInArrow(frees_memory(lambda b: _anchor_rows(b, length, True)), "gram long, id long, copy long, packed long")
    found = scratch.table("found", found.join(repeated.hint("merge"), "gram"))
    scratch.drop("repeated")
    scratch.sweep()
    # A set, as rows that repeat id and text are one document.
    lists = found.groupBy("id", "copy").agg(F.collect_set(F.struct("gram", "n", "packed")).alias("found"))
    texts = docs.select("id", "copy", "text").join(lists, ["id", "copy"]).dropDuplicates(["id", "copy"]).select("id", "copy", "text", "found")
    contexts = scratch.table("contexts", texts.mapInArrow(frees_memory(lambda b: _cut(b, length)), _CONTEXT_DDL))
    scratch.drop("found")
    scratch.sweep()
    spans = _dealt_spans(contexts, length, scratch)
    scratch.drop("contexts")
    scratch.sweep()
    return spans


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """For every row: bytes, removed bytes, maximal removed runs, and the SHA-256 of the bytes that stay; with ``texts`` those bytes too.

    A byte is removed if a string of ``length`` bytes covers it that also starts earlier: in a smaller id, or further up in
    the same document, overlaps included. Strings are judged on the input and never cross documents. Null and empty texts have no bytes.
    Null ids come before all others; rows that repeat an id are told apart by their text, and rows that repeat both are one document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    ids = docs.select(key.alias("id"))
    # Where no id repeats (null ids count as one), ids alone name documents.
    alone = ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    copy = F.lit(0).cast("long") if alone else F.xxhash64(key, F.col(text_col))
    docs = docs.select(key.alias("id"), copy.alias("copy"), F.col(text_col).alias("text"))
    spans = repeated_spans(docs, length, scratch)
    marks = spans.groupBy("id", "copy").agg(F.collect_set(F.struct(F.col("from").alias("a"), F.col("to").alias("b"))).alias("spans"))
    rows = docs.join(marks, ["id", "copy"], "left").select("id", "text", "spans.a", "spans.b")
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")

    @frees_memory
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, a, b in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                raw = (text.as_py() or "").encode()
                removed = spans_n = 0
                if a.is_valid:
                    edge = np.zeros(len(raw) + 1, dtype=np.int32)
                    np.add.at(edge, a.values.to_numpy(), 1)
                    np.add.at(edge, b.values.to_numpy(), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    spans_n = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                    kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                else:
                    kept = raw
                for column, value in zip(out, (len(raw), removed, spans_n, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    column.append(value)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if texts:
                columns.append(pa.array(out[4], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    found = rows.mapInArrow(run, schema)
    return found.withColumn("id", F.when(F.col("id") != _NO_ID, F.col("id"))).withColumnRenamed("id", "doc_id")
