"""Secrets in text: fixed patterns, plus high-entropy strings found by sliding windows with incremental character counts."""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .text import frees_memory

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 24 or more is what the plain run pattern finds once shorter matches are dropped.
HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class EntropyRule:
    """What counts as a high-entropy string.

    ``window`` characters slide over each candidate; a candidate is reported when the largest window entropy (bits for each
    character) reaches the threshold of its character class: ``hex`` for strings of hexadecimal digits alone, ``mixed`` for
    those with a digit, a lower-case and an upper-case letter, ``lower`` and ``upper`` for digits with letters of one case. ``allowed`` suppresses candidates by
    full match; the defaults are unique identifiers, dates, and digit-only or sample strings."""

    window: int = 20
    hex_bits: float = 3.0
    mixed_bits: float = 3.9
    lower_bits: float = 3.7
    upper_bits: float = 3.7
    allowed: tuple[str, ...] = (
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
        r"[0-9_=+/-]+",
        r"(?i:.*(?:example|sample|placeholder|xxxx).*)",
        r"(?:[A-Za-z]+[/_=+-])*[A-Za-z]+\d{0,4}",
    )
    _allow: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "_allow", re.compile("|".join(f"(?:{p})" for p in self.allowed) or r"(?!)"))


def peak_entropy(text: str, window: int) -> float:
    """Largest Shannon entropy of the windows of a text, from counts that change by one character in and one out.

    With counts c over w characters the entropy is log2(w) - sum(c log2 c) / w; the sum is kept up to date."""
    w = min(window, len(text))
    if not w:
        return 0.0
    log = [0.0, *(c * math.log2(c) for c in range(1, w + 1))]
    counts: dict[str, int] = {}
    total = 0.0
    for c in text[:w]:
        k = counts.get(c, 0)
        total += log[k + 1] - log[k]
        counts[c] = k + 1
    least = total
    for old, new in zip(text, text[w:]):
        if old != new:
            k = counts[old]
            total += log[k - 1] - log[k]
            counts[old] = k - 1
            k = counts.get(new, 0)
            total += log[k + 1] - log[k]
            counts[new] = k + 1
            least = min(least, total)
    return math.log2(w) - least / w


def entropy_spans(text: str, rule: EntropyRule) -> list[tuple[int, int]]:
    """Candidate strings that no allow-list pattern matches and whose entropy reaches the threshold of their class."""
    out = []
    for m in _CANDIDATE.finditer(text):
        if m.end() - m.start() < rule.window:
            continue
        s = m.group()
        if s.isalpha() or rule._allow.fullmatch(s):
            continue
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
            least = rule.hex_bits
        elif not re.search("[0-9]", s):
            continue
        elif re.search("[a-z]", s) and re.search("[A-Z]", s):
            least = rule.mixed_bits
        elif rule._allow.fullmatch(s.strip("/_=+-")):
            # Paths are slugs behind a separator.
            continue
        else:
            least = rule.lower_bits if re.search("[a-z]", s) else rule.upper_bits
        if peak_entropy(s, rule.window) >= least:
            out.append((m.start(), m.end()))
    return out


def secret_spans(text: str, rule: EntropyRule = EntropyRule()) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start and then kind as in KINDS.

    An entropy span is added where it reaches beyond every base span; base spans always stay."""
    base = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    base += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [("hex", *m.span()) for m in HEX.finditer(text)]
    more = [("entropy", a, b) for a, b in entropy_spans(text, rule) if not any(x <= a and b <= y for _, x, y in base)]
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, rule: EntropyRule = EntropyRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its spans as an array of (kind, start, end), empty where there are none.

    Null and empty texts have no spans; repeated rows give repeated results; texts of any length are searched whole."""
    id_type = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @frees_memory
    def run(batches):
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in secret_spans(t.as_py() or "", rule)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, span)], ["doc_id", "spans"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(text: str, rule: EntropyRule = EntropyRule(), mark: str = "[SECRET]") -> str:
    """The text with every stretch that spans cover replaced by ``mark``; overlapping spans make one stretch."""
    out, done = [], 0
    for _, a, b in secret_spans(text, rule):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact_secrets(docs: DataFrame, rule: EntropyRule = EntropyRule(), mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without secrets. Null texts stay null."""
    at, schema = docs.columns.index(text_col), docs.schema

    @frees_memory
    def run(batches):
        for batch in batches:
            texts = [None if (t := x.as_py()) is None else redact(t, rule, mark) for x in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, schema)


def digest(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
