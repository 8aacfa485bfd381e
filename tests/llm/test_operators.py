"""Operators against brute force, exact round trips and held-out labels."""

import collections
import hashlib
import math
import re
import zlib
from unittest import mock

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinspark.llm import bpe, components, jaccard, line_dedup, packing, quality, queries, secrets, suffix_dedup, token_counts, topk, toxicity
from kinspark.llm.vocabulary import library

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", " \n ", "a\x1cb  \x85c<|endoftext|> x<|ENDOFTEXT|>  É́ ΣΑΣ ﬁ 日本 ½٣", "x" * 5000, "'ll 'LL don't  \t\n\n 12345"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = [(10_000 + k, t) for k, t in enumerate(ODD)] + [(20_000, None), (None, None)]
    copies = base.where("doc_id < 20").select(F.col("doc_id") + 30_000, F.concat(F.lit("One more line here.\n"), "text"))
    return base.union(spark.createDataFrame(more, "doc_id long, text string")).union(copies).coalesce(3).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect()))


def ids_of(df):
    return {(-1 if r[0] is None else r[0]): tuple(r)[1:] for r in df.collect()}


def tokenizer(path):
    return library(open(path, "rb").read())


def test_token_counts(docs, texts):
    t = tokenizer(queries.BYTE_BPE)
    want = {i: (len(x.encode()), n := len(t.encode(x, add_special_tokens=False).ids), n > 512) for i, x in texts}
    assert ids_of(token_counts.count_tokens(docs, queries.BYTE_BPE, 512)) == want


def test_bpe_round_trip(docs, texts):
    t = tokenizer(queries.WORD_BPE)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {i: (len(c), sha(" ".join(map(str, c))), sha(t.decode(c, skip_special_tokens=False))) for i, x in texts for c in [t.encode(x, add_special_tokens=False).ids]}
    assert ids_of(bpe.encode_and_decode(docs, queries.WORD_BPE, block_chars=50_000)) == want
    shown = bpe.encode_and_decode(docs.where("doc_id = 10002"), queries.WORD_BPE, texts=True).first()
    assert shown.ids == t.encode(ODD[2], add_special_tokens=False).ids and shown.decoded == t.decode(shown.ids, skip_special_tokens=False)


def test_packing(docs, texts):
    t, cap = tokenizer(queries.BYTE_BPE), 256
    rows = packing.pack(docs, queries.BYTE_BPE, cap, pieces_a_task=500).toPandas()
    rows["doc_id"] = rows["doc_id"].fillna(-1).astype(int)
    for i, x in texts:
        ids = [*t.encode(x, add_special_tokens=False).ids, 0]
        part = rows[rows.doc_id == i].sort_values("piece")
        assert part["length"].sum() == len(ids) and (part["length"].iloc[1:] == cap).all() and len(part) == -(-len(ids) // cap)
        for r in part.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    for _, s in rows.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= cap
    assert rows["sequence_id"].nunique() <= 1.02 * -(-rows["length"].sum() // cap) + 2


def test_sum_of_squares_places_by_the_smallest_sum():
    bins, offsets = packing.sum_of_squares(np.array([6, 6, 5, 4, 4, 5, 10]), 10)
    assert bins.tolist() == [0, 1, 2, 1, 0, 2, 3] and offsets.tolist() == [0, 0, 0, 6, 6, 5, 0]


def brute_components(texts, size, percent):
    sets, where, parent = [], collections.defaultdict(list), list(range(len(texts)))
    for _, t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets.append(frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[k : k + size]) for k in range(len(w) - size + 1)]))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        seen = collections.Counter(j for g in s for j in where[g])
        for g in s:
            where[g].append(k)
        for j, n in seen.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(texts):
        least[find(k)] = min(least.get(find(k), 1 << 60), i)
    return {i: (len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(texts)}


@pytest.mark.parametrize("small", [128, 2])
def test_jaccard(docs, texts, small, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    want = brute_components([x for x in texts if x[0] >= 0], 4, 85)
    got = {i: v[:2] for i, v in ids_of(jaccard.near_duplicates(docs)).items()}
    assert got.pop(-1) == (0, None) and got == want


def brute_links(texts, size, percent):
    """For each text the number of other sets that its set links with."""
    sets = {}
    for i, t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[k : k + size]) for k in range(len(w) - size + 1)])
    near = lambda a, b: a != b and 100 * len(a & b) >= percent * len(a | b)
    found = {s: sum(near(s, x) for x in set(sets.values())) for s in set(sets.values())}
    return {i: found[s] for i, s in sets.items()}


@pytest.mark.parametrize("small", [128, 2])
def test_jaccard_counts_all_links(spark, small, monkeypatch):
    """A group of texts that all link, with two copies, a chain, a pair and a loner; blocks smaller than the group and larger than the rest."""
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    base = [f"v{k}" for k in range(200)]
    group = [" ".join([*base[:k], f"y{k}", *base[k + 1 :]]) for k in range(40)]
    texts = group + group[:2] + [t for _, t in chains(spark, 30)[1]] + ["a b c d e f g h i j k l m n o p q r s t u v w x y z", "a b c d e f g h i j k l m n o p q r s t u v w x y z0", "q r s t"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string")
    assert {i: v[2] for i, v in ids_of(jaccard.near_duplicates(df)).items()} == brute_links(rows, 4, 85)


def chains(spark, n=60):
    """Texts that differ by one more word each: near neighbours link, far ones don't."""
    base = [f"w{k}" for k in range(150)]
    rows = [(k, " ".join(base[:0] + [f"x{j}" if j * 2 < k else w for j, w in enumerate(base)])) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.mark.parametrize("small", [128, 4])
def test_jaccard_chain(spark, small, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    df, rows = chains(spark)
    assert {i: v[:2] for i, v in ids_of(jaccard.near_duplicates(df)).items()} == brute_components(rows, 4, 85)


def test_components_never_end_unfinished(monkeypatch):
    """Edges whose state never repeats raise instead of giving labels."""

    class Edges:
        count = 0

        def __getattr__(self, _):
            return lambda *_: self

        def first(self):
            self.count += 1
            return self.count

    edges = Edges()
    edges.table = lambda *_: edges
    for name in ("_small_star", "_large_star"):
        monkeypatch.setattr(components, name, lambda e: e)
    monkeypatch.setattr(components, "F", mock.MagicMock())
    with pytest.raises(RuntimeError):
        components.connected_components(edges, edges, "x")


def test_keep_one(docs, texts):
    want = brute_components([x for x in texts if x[0] >= 0], 4, 85)
    kept = {r.doc_id for r in jaccard.keep_one(docs, 4, 85).collect()} - {None}
    assert kept == {i for i, (_, c) in want.items() if i == c}


def brute_lines(texts, lines=3, words=50):
    """Maximal runs that also start earlier, by comparing every place with every earlier one through a table of runs."""
    seqs = [[(k, x) for k, x in enumerate(t.split("\n")) if WORD.search(x)] for _, t in texts]
    gone, longest = [set() for _ in texts], [0] * len(texts)
    places = collections.defaultdict(list)
    for n, q in enumerate(seqs):
        for a in range(len(q)):
            best = 0
            for m, b in places[q[a][1]]:
                d = 0
                while a + d < len(q) and b + d < len(seqs[m]) and q[a + d][1] == seqs[m][b + d][1]:
                    d += 1
                best = max(best, d)
            places[q[a][1]].append((n, a))
            if best >= lines or sum(len(WORD.findall(x)) for _, x in q[a : a + best]) >= words:
                gone[n] |= set(range(a, a + best))
                longest[n] = max(longest[n], best)
    out = {}
    for (i, t), q, g, d in zip(texts, seqs, gone, longest, strict=True):
        away = {q[a][0] for a in g}
        out[i] = (len(away), sum(a - 1 not in g for a in g), d, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in away))
    return out


def lines_found(docs):
    cols = [F.greatest(F.lit(0), F.size(F.coalesce("removed", F.array().cast("array<int>")))), F.coalesce("n_runs", F.lit(0)), F.coalesce("longest", F.lit(0)), F.coalesce(line_dedup.kept_text(), F.lit(""))]
    return ids_of(line_dedup.mark_repeated_lines(docs).select("row.doc_id", *cols))


def test_line_dedup(docs, texts):
    assert lines_found(docs) == brute_lines(texts)


def test_line_dedup_of_random_runs(spark):
    """Few distinct lines, so runs of every length overlap within documents and between them."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(60):
        if i % 4 == 3:
            _, t = rows[int(rng.integers(len(rows)))]
            parts = t.split("\n")
            a = int(rng.integers(0, len(parts)))
            rows.append((i, "\n".join([*parts[a : a + int(rng.integers(1, 30))], "own line " + str(i), *parts[: int(rng.integers(0, 20))]])))
        else:
            rows.append((i, "\n".join("line " + "word " * (30 * int(k == 3)) + str(k) for k in rng.integers(0, 12, int(rng.integers(1, 40))))))
    assert lines_found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_lines(rows)


def test_deep_rounds_decide_what_goes(spark, monkeypatch):
    """A copied text of 40 lines is one maximal run; without the deeper rounds most of it would stay."""
    text = "\n".join(f"line number {k}" for k in range(40))
    df = spark.createDataFrame([(1, text), (2, "x\n" + text + "\ny")], "doc_id long, text string")
    assert lines_found(df)[2] == (40, 1, 40, "x\ny")
    whole = line_dedup._doubled
    monkeypatch.setattr(line_dedup, "_doubled", lambda *a: whole(*a)[:2])
    assert lines_found(df)[2][0] < 10


def brute_bytes(texts, length):
    seen, out = set(), {}
    for i, t in texts:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(b[p : p + length])
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [8_192, 3])
def test_suffix_dedup(docs, texts, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    assert ids_of(suffix_dedup.remove_repeats(docs)) == brute_bytes(texts, 100)


def test_sorted_suffixes():
    data = np.random.default_rng(1).integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[200:600]
    places = np.arange(0, 2700)
    raw = data.tobytes()
    found = [raw[p : p + 100] for block in suffix_dedup.sorted_suffixes(data, places, 100) for p in block]
    assert found == sorted(found) and len(found) == len(places) > len(set(found))


def test_difference_cover_decides_long_ties(monkeypatch):
    """Without the ranks of the sample, suffixes that share their first bytes stay unsorted."""
    monkeypatch.setattr(suffix_dedup, "_sample_ranks", lambda data, *_: np.zeros(len(data) + 20, dtype=np.int64))
    data = np.tile(np.arange(97, 107), 60).astype(np.uint8)
    data[300] = 122
    raw = data.tobytes()
    found = [raw[p : p + 100] for block in suffix_dedup.sorted_suffixes(data, np.arange(500), 100) for p in block]
    assert found != sorted(found)


def test_anchors_of_a_text_longer_than_a_slice(monkeypatch):
    data = np.random.default_rng(2).integers(97, 123, 60_000).astype(np.uint8)
    data[40_000:41_000] = data[5_000:6_000]
    whole = suffix_dedup.anchors(data, np.array([0, len(data)]), 100)
    monkeypatch.setattr(suffix_dedup, "SLICE", 7_000)
    cut = suffix_dedup.anchors(data, np.array([0, len(data)]), 100)
    for parts in (whole, cut):
        covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(parts[1], parts[2], strict=True)])
        assert covered.tolist() == list(range(len(data) - 99))
    assert set(whole[0]) == set(cut[0])


def test_crowded_bucket_at_the_real_size(spark):
    """More contexts than CROWD around one string, equal and different, give what brute force gives."""
    n = suffix_dedup.CROWD + 900
    core = "the one string that very many of the documents hold"
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    side = lambda k: "".join(letters[rng.integers(0, 27, k)])
    fixed = [(side(30), side(30)) for _ in range(40)]
    rows = []
    for i in range(n):
        a, b = fixed[int(rng.integers(40))] if i % 3 else (side(30), side(30))
        rows.append((i, a + core + b))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ids_of(suffix_dedup.remove_repeats(df)) == brute_bytes(rows, 100)


def test_topk(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    bad = spark.createDataFrame([(90_000, None), (90_050, [1.0, None]), (90_100, [float("nan")] * 64), (None, [0.0] * 64)], "vec_id long, embedding array<float>")
    twins = table.where("vec_id < 60").select(F.col("vec_id") + 70_000, "embedding")
    got = {tuple(r) for r in topk.top_k(topk.integer_vectors(table.union(bad).union(twins)), F.expr("vec_id % 50 = 0")).collect()}
    frame = table.union(twins).toPandas()
    x, ids, want = np.floor(256 * np.stack(frame.embedding).astype(float)).astype(int), frame.vec_id.to_numpy(), set()
    for q in np.flatnonzero(ids % 50 == 0):
        score = x @ x[q]
        best = [j for j in np.lexsort((ids, -score)) if j != q][:5]
        want |= {(int(ids[q]), k + 1, int(ids[j]), int(score[j])) for k, j in enumerate(best)}
    assert got == want


def test_no_random_access_stops_early():
    rng = np.random.default_rng(0)
    x = rng.integers(-20, 20, (2000, 3))
    x[:5] = 400
    at, rows, reached = topk.no_random_access(x, np.arange(2000), np.array([[1, 2, 3]]), np.array([-1]), 5)
    assert sorted(rows) == [0, 1, 2, 3, 4] and not at.any() and reached[0] == 250


def test_shared_bounds_stop_reading_of_the_shipped_embeddings():
    """With the k-th best score of all rows known, most queries stop before the lists end, and half of the lists rules most rows out."""
    import pandas as pd

    frame = pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet")
    x, ids = np.floor(256 * np.stack(frame.embedding).astype(float)).astype(np.int64), frame.vec_id.to_numpy()
    q = np.flatnonzero(ids % 50 == 0)
    scores = x[q] @ x.T
    scores[np.arange(len(q)), q] = np.iinfo(np.int64).min
    kth = np.sort(scores, axis=1)[:, -5]
    at, rows, reached = topk.no_random_access(x, ids, x[q], ids[q], 5, kth.astype(float))
    assert (reached < len(x)).mean() > 0.5
    for k in range(len(q)):
        assert set(np.flatnonzero(scores[k] > kth[k])) <= set(rows[at == k]) and len(rows[at == k]) <= 8
    lower, upper = topk.SortedLists(x).bounds(x[q].astype(float), len(x) // 2)
    assert (lower <= x[q] @ x.T + 1e-6).all() and (upper >= x[q] @ x.T - 1e-6).all()
    _, upper = topk.SortedLists(x).bounds(x[q].astype(float), 7 * len(x) // 8)
    assert (upper >= kth[:, None]).mean() < 0.05


@pytest.mark.parametrize("blocks", [(4096, 256), (64, 4)])
def test_topk_in_blocks(spark, blocks, monkeypatch):
    """Many small blocks, two dimensions, ties, and fewer rows than k."""
    monkeypatch.setattr(topk, "VECTOR_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 5).tolist()) for i in range(400)] + [(1000 + i, [i, 1]) for i in (0, 50, 100)]
    df = spark.createDataFrame(rows, "vec_id long, components array<long>").repartition(5)
    got = {tuple(r) for r in topk.top_k(df, F.expr("vec_id % 50 = 0"), 5).collect()}
    want = set()
    for i, v in rows:
        if i % 50 == 0:
            best = sorted((-int(np.dot(v, w)), j) for j, w in rows if j != i and len(w) == len(v))[:5]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert got == want


#: The contract's patterns, written out anew.
ASSIGNED = re.compile("(?i:(password|passwd|secret|token|api_?key)[\"']?[ ]*[:=][ ]*[\"']?)([A-Za-z0-9+/_.=-]+)")


def brute_secrets(t):
    out = [("assign", *m.span()) for m in ASSIGNED.finditer(t) if len(m.group(2)) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]


def brute_entropy(t, window=20):
    """Spans of strings of key characters by the entropy of every window, counted from scratch."""
    out = []
    for m in re.finditer("[A-Za-z0-9+/_=-]+", t):
        s = m.group()
        letters, lower, upper, digit = (any(map(f, s)) for f in (str.isalpha, str.islower, str.isupper, str.isdigit))
        hexed = set(s) <= set("0123456789abcdef") or set(s) <= set("0123456789ABCDEF")
        if len(s) < window or s.isalpha() or not letters or not digit and not hexed:
            continue
        if re.fullmatch("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", s) or any(x in s.lower() for x in ("example", "sample", "placeholder", "xxxx")):
            continue
        slug = r"([A-Za-z]+[/_=+-])*[A-Za-z]+[0-9]{0,4}"
        if re.fullmatch(slug, s) or not (lower and upper) and not hexed and re.fullmatch(slug, s.strip("/_=+-")):
            continue
        if not (lower and upper) and not hexed and re.fullmatch("[0-9_=+/-]+|" + slug, s.strip("/_=+-")):
            continue
        entropies = [sum(-n / window * math.log2(n / window) for n in collections.Counter(s[a : a + window]).values()) for a in range(len(s) - window + 1)]
        if max(entropies) >= (3.0 if hexed else 3.9 if lower and upper else 3.7):
            out.append(("entropy", *m.span()))
    return out


def test_entropy_spans_against_brute_force(spark, docs, texts):
    rng = np.random.default_rng(6)
    signs = ["0123456789abcdef", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "".join(map(chr, range(48, 123))), "ab-/_=+1"]
    rows = [(100_000 + i, " ".join("".join(np.array(list(signs[int(k)]))[rng.integers(0, len(signs[int(k)]), int(rng.integers(10, 60)))]) for k in rng.integers(0, len(signs), 30))) for i in range(40)]
    got = ids_of(secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").union(docs.where("doc_id is not null"))))
    n = 0
    for i, t in [*rows, *((i, t) for i, t in texts if i >= 0)]:
        base = brute_secrets(t)
        want = [x for x in brute_entropy(t) if not any(a <= x[1] and x[2] <= b for _, a, b in base)]
        assert [tuple(x) for x in got[i][0] if x["kind"] == "entropy"] == want
        n += len(want)
    assert n > 100


def test_secrets(spark, docs, texts, sf_dir):
    order = secrets.KINDS.index
    for i, v in ids_of(secrets.find_secrets(docs)).items():
        base = sorted(brute_secrets(dict(texts)[i]), key=lambda s: (s[1], order(s[0])))
        assert [tuple(s) for s in v[0] if s["kind"] != "entropy"] == base


def test_entropy():
    assert abs(secrets.peak_entropy("ab" * 20, 20) - 1) < 1e-9
    key = "x9Kq2LmZ7vTb4RwP8sYd"
    assert [s[0] for s in secrets.secret_spans(f"here {key} there")] == ["entropy"]
    assert secrets.secret_spans("123e4567-e89b-12d3-a456-426614174000 and achlichkeitlichunglichkeitsbehälter") == []
    assert secrets.redact(f"a {key} b PASSWORD = 'hunter22'") == "a [SECRET] b [SECRET]'"


def test_entropy_of_one_case_and_around_base_spans():
    for key in ("k3x9q0vz7m2tb8w4ruy1pd6hs5gj0nfe3calo", "JBSWY3DPEHPK3PXPQ5TNZ2VK7LMA4GRC"):
        assert secrets.secret_spans(f"here {key} there") == [("entropy", 5, 5 + len(key))]
    key = "Zq7Tx_" + "0123456789abcdef01234567" + "_Kp9Vw3LmRs8YtBn2"
    assert secrets.redact(f"a {key} b") == "a [SECRET] b"
    assert [s[0] for s in secrets.secret_spans(f"a {key} b")] == ["entropy", "hex"]
    assert secrets.secret_spans("the-well-known-state-of-the-art-2024 /usr/share/lib/python3") == []


def test_quality_statistics(docs, texts):
    got = ids_of(quality.text_statistics(docs))
    for i, t in texts:
        w = WORD.findall(t)
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert got[i][:5] == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))


def test_kept_is_the_first_rule_that_holds(docs, spark):
    """The decision list, one document and one threshold at a time in plain Python."""
    stats = [dict(r.asDict()) for r in quality.text_statistics(docs).collect()]
    rules = [quality.Rule((quality.Condition("symbols_a_word", True, 0.01), quality.Condition("n_words", False, 300.0))), quality.Rule((quality.Condition("words_a_line", False, 4.0),))]
    frame = quality.text_statistics(docs).withColumn("kept", quality.verdict(rules))
    for r in frame.collect():
        words, lines = r.n_words, r.n_lines
        first = (r.n_symbols / words if words else 0.0) >= 0.01 and words < 300
        second = (words / lines if lines else 0.0) < 4.0
        assert r.kept == (not (first or second))
    assert len(stats) == frame.count() and 0 < frame.where("kept").count() < len(stats)


def test_rules_cover_what_was_planted():
    rng = np.random.default_rng(2)
    stats = {c: rng.integers(50, 500, 900).astype(float) for c in quality.STATISTICS}
    stats["n_symbols"] = np.where(np.arange(900) % 5 == 0, 400.0, 1.0)
    bad = np.arange(900) % 5 == 0
    rules = quality.learn_rules(stats, bad)
    hit = np.zeros(900, dtype=bool)
    for rule in rules:
        hit |= rule.holds(quality.feature_arrays(stats))
    assert not (hit & ~bad).any() and hit.sum() > 0.9 * bad.sum() and rules[0].conditions[0].feature == "symbols_a_word"


def test_quality_rules_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.judge_quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    good, bad = (kept.where(f"quality = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.99 and bad < 0.15


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_severity(docs, labels.where("doc_id % 2 = 0"))
    assert model.thresholds[0] < model.thresholds[1]
    found = toxicity.grade_severity(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    caught, wrong = (found.where(f"toxic = {t}").agg(F.avg(F.col("rejected").cast("int"))).first()[0] for t in (1, 0))
    assert caught > 0.9 and wrong < 0.005


def test_severity_against_brute_force(docs, texts):
    """Word and word-beginning counts, logits and the expected grade, one text at a time in plain Python."""
    model = toxicity.SeverityModel({"the": 0.4, "and": -0.2, "sch*": 0.7, "ent*": 0.3, "dont": 9.0}, (0.5, 1.5))
    got = ids_of(toxicity.grade_severity(docs, model, reject_at=0.4))
    for i, t in texts:
        words = re.findall(r"[^\W\d_]+", t.lower())
        x = {"the": words.count("the"), "and": words.count("and"), "sch*": sum(w.startswith("sch") and len(w) > 3 for w in words), "ent*": sum(w.startswith("ent") and len(w) > 3 for w in words), "dont": words.count("dont")}
        score = sum(model.weights[f] * (1 + math.log(n)) for f, n in x.items() if n)
        p = [1 / (1 + math.exp(h - score)) for h in model.thresholds]
        assert np.allclose(got[i][:3], [*p, sum(p)]) and got[i][3] == (p[0] >= 0.4)


def test_cumulative_link_reaches_the_optimum():
    """The penalised likelihood, written out by hand, falls in no direction from the fit; as does plain gradient descent's."""
    rng = np.random.default_rng(4)
    x = rng.poisson(0.7, (80, 4)).astype(float)
    grades = np.clip((x @ [1.0, -0.5, 0.3, 0.0] + rng.logistic(size=80)).round().astype(int), 0, 2)
    rows, cols = np.nonzero(x)
    w, t = toxicity.fit_cumulative_link(rows, cols, x[rows, cols], grades, 4, 3, 0.2, steps=2000)

    def loss(p):
        cuts = np.array([-np.inf, p[4], p[4] + np.exp(p[5]), np.inf])
        above = lambda k: np.array([1 / (1 + np.exp(cuts[g + k] - z)) for g, z in zip(grades, x @ p[:4], strict=True)])
        return -np.log(above(0) - above(1)).sum() + 0.1 * (p[:4] ** 2).sum() + 0.005 * (p[4:] ** 2).sum()

    best = np.array([*w, t[0], math.log(t[1] - t[0])])
    at = loss(best)
    slope = np.array([(loss(best + d) - loss(best - d)) / 2e-4 for d in 1e-4 * np.eye(6)])
    assert np.abs(slope).max() < 0.05
    start = np.zeros(6)
    for _ in range(3000):
        start -= 0.005 * np.array([(loss(start + d) - loss(start - d)) / 2e-4 for d in 1e-4 * np.eye(6)])
    assert abs(loss(start) - at) < 0.01 * at


def test_probabilities_are_those_of_the_labelled_documents(spark):
    """Ten clean documents for each toxic one, a sample of as many of either: the mean probability is the true share."""
    rng = np.random.default_rng(8)
    rows, marks = [], []
    for i in range(2200):
        toxic = int(i % 11 == 0)
        words = [f"w{k}" for k in rng.integers(0, 200, 20)] + ["bad" + "abc"[int(rng.integers(3))] if rng.random() < (0.7 if toxic else 0.1) else "fine"]
        rows.append((i, " ".join(re.sub(r"\d", lambda m: "qwertyuiop"[int(m[0])], w) for w in words)))
        marks.append((i, 1, toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_severity(df, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), toxicity.FitParameters(sample=400, least_documents=5))
    mean = toxicity.grade_severity(df, model).agg(F.avg("p_mild")).first()[0]
    assert abs(mean - 1 / 11) < 0.06


def test_grades_come_from_the_other_half(spark):
    """A word that only one half of the sample holds doesn't grade the documents of that half."""
    rows = [(i, "awfulword plain text here" if i % 2 else "plain text here now") for i in range(300)]
    df, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, 1, i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    words = df.join(labels, "doc_id").select("doc_id", "toxic", F.explode(F.split("text", " ")).alias("word"), F.lit(1).alias("n"))
    half = F.when((F.col("word") == "awfulword"), 0).otherwise((F.col("doc_id") % 2).cast("int"))
    found = toxicity._associations(words.withColumn("half", half), {(t, h): 75 for t in (0, 1) for h in (0, 1)}, toxicity.FitParameters()).where("word = 'awfulword'").first()
    assert (found.leans0, found.leans1) == (False, True)


def test_cumulative_link_orders_grades():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 2))
    z = x @ [2.0, -1.0] + rng.logistic(size=600)
    grades = (z > -1).astype(int) + (z > 1.5)
    rows, cols = np.repeat(np.arange(600), 2), np.tile([0, 1], 600)
    w, t = toxicity.fit_cumulative_link(rows, cols, x.ravel(), grades, 2, 3, 0.1)
    assert abs(w[0] - 2) < 0.4 and abs(w[1] + 1) < 0.3 and abs(t[0] + 1) < 0.4 and abs(t[1] - 1.5) < 0.4
