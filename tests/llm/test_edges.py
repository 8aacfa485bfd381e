"""Nulls, empty and repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from test_operators import WORD, brute_components, brute_entropy, brute_lines, brute_secrets

import corpus_pipeline
from kinspark.llm import bpe, jaccard, line_dedup, packing, quality, queries, secrets, suffix_dedup, token_counts, topk, toxicity

LONG = "alpha beta gamma delta " * 400
ROWS = [(1, "one two three four five\nsix\nseven\neight"), (1, "one two three four five\nsix\nseven\neight"), (1, "other text with the same id"), (2, None), (None, "no id here at all"), (None, None), (3, ""), (4, " \n\n"), (5, LONG), (5, LONG), (6, "one two three four five\nsix\nseven\neight")]
EXTRA = ("id", "copy", "node", "n", "shingle", "word", "block", "rank", "spans", "at", "key", "toxic", "_lines_", "prefix", "_lines", "_removed", "_runs", "_depth", "_bucket", "_seen", "_bits", "_doc_key", "_kept_id", "row", "doc", "lines", "removed", "kept", "part", "x", "source", "number")

OPERATORS = {
    "tokens": lambda d, t: token_counts.count_tokens(d, queries.BYTE_BPE, 512),
    "bpe": lambda d, t: bpe.encode_and_decode(d, queries.WORD_BPE),
    "secrets": lambda d, t: secrets.find_secrets(d),
    "quality": lambda d, t: quality.judge_quality(d, t),
    "toxicity": lambda d, t: toxicity.grade_severity(d, toxicity.fit_severity(d, t)),
    "lines": lambda d, t: line_dedup.drop_repeated_lines(d),
    "bytes": lambda d, t: suffix_dedup.remove_repeats(d),
    "jaccard": lambda d, t: jaccard.near_duplicates(d),
}


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in EXTRA})


def labels(spark, rows=((1, 1, 0), (2, None, 1), (None, 0, 1), (5, 0, 1), (5, 1, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    out = OPERATORS[name](table(spark, ROWS), labels(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](table(spark, []), labels(spark, [])).collect() == []


def test_repeated_rows_agree(spark):
    out = suffix_dedup.remove_repeats(table(spark, ROWS)).where("doc_id = 5").collect()
    assert len(out) == 2 and out[0] == out[1] and out[0].n_removed > 0
    found = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.near_duplicates(table(spark, ROWS)).collect()}
    assert found[6, 5] == 1 and found[2, 0] == 2 and found[None, 0] is None
    kept = line_dedup.drop_repeated_lines(table(spark, ROWS))
    assert kept.columns == table(spark, ROWS).columns
    texts = {r.doc_id: r.text for r in kept.where("doc_id in (2, 3, 6)").collect()}
    assert texts == {2: None, 3: "", 6: ""}


def test_packing_and_topk_of_nothing(spark):
    assert packing.pack(table(spark, []), queries.BYTE_BPE, 64).collect() == []
    assert packing.pack(table(spark, ROWS), queries.BYTE_BPE, 64).where("doc_id is null").count() == 2
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.integer_vectors(none), F.expr("vec_id % 50 = 0")).collect() == []
    short = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0]), (50, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(topk.integer_vectors(short), F.expr("vec_id % 50 = 0")).collect()] == [(0, 1, 1, 131072)]


def test_pipeline_stages_keep_their_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (90_001, "", "en", "s", 0)], docs.schema)
    now = docs.union(odd)
    names = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns
        now = spark.createDataFrame(now.collect(), docs.schema)
        names.append((name, now.count()))
    assert [n for n, _ in names] == ["toxicity", "line_dedup", "jaccard_join", "secret_scan"]
    assert names[1][1] <= names[0][1] and names[3][1] == names[2][1] and names[2][1] > 100
    assert now.where("doc_id is null or doc_id = 90001").count() == 2


def test_stages_against_brute_force(spark, sf_dir):
    """The three middle stages, each on what its predecessor kept: lines by comparing all places, copies by all pairs, marks by patterns."""
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    copies = base.where("doc_id < 30").withColumns({"doc_id": F.col("doc_id") + 500_000, "text": F.concat(F.lit("Another first line.\n"), "text")})
    docs = base.union(copies).coalesce(2)
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    out = line_dedup.drop_repeated_lines(docs, emptied=False)
    want = {i: v[3] for i, v in brute_lines(texts).items()}
    gutted = {i for i, t in texts if WORD.search(t) and not WORD.search(want[i])}
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, sf_dir).collect()}
    assert kept == {i: t for i, t in want.items() if i not in gutted} and gutted
    assert out.count() == len(kept)
    now = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in kept.items()], base.schema)
    groups = brute_components(sorted(kept.items()), 5, 80)
    one = corpus_pipeline.drop_near_duplicates(spark, now, sf_dir)
    assert {r.doc_id for r in one.collect()} == {i for i, (_, c) in groups.items() if i == c}
    for r in corpus_pipeline.redact_secrets(spark, one, sf_dir).collect():
        spans, text, done = sorted((a, b) for _, a, b in [*brute_secrets(kept[r.doc_id]), *brute_entropy(kept[r.doc_id])]), [], 0
        for a, b in spans:
            if a >= done:
                text += [kept[r.doc_id][done:a], "[SECRET]"]
            done = max(done, b)
        assert r.text == "".join([*text, kept[r.doc_id][done:]]) and r.n_chars == len(r.text)


def test_repeated_and_null_ids_of_near_copies(spark):
    """Null ids that share a component leave one; another text of an id doesn't keep its copy; rows without words all stay."""
    words = [f"w{k}" for k in range(60)]
    one, two = " ".join(words), " ".join(["v0", *words[1:]])
    other, third = " ".join(f"x{k}" for k in range(60)), " ".join(["y0", *(f"x{k}" for k in range(1, 60))])
    rows = [(None, one), (None, two), (3, other), (7, third), (7, "a text of its own with some more words in it"), (8, ""), (8, ""), (9, None), (7, "a text of its own with some more words in it")]
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(table(spark, rows)).collect()), key=str)
    assert len([r for r in kept if r[0] is None]) == 1
    assert [r for r in kept if r[0] is not None] == sorted([(3, other), rows[4], (8, ""), (8, ""), (9, None)], key=str)


def test_words_whose_hashes_met_modulo_a_power_of_two(spark):
    """Thue and Morse's strings of 512 letters and their complements: differing words, so nothing links."""
    s = [0]
    while len(s) < 512:
        s += [1 - x for x in s]
    a, b = "".join("ab"[x] for x in s), "".join("ba"[x] for x in s)
    rows = jaccard.near_duplicates(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in rows) == [(1, 1, 0), (2, 2, 0)]


def test_texts_longer_than_a_chunk(spark):
    """One document of some MB beside small ones: bytes, words and lines are those of the whole text."""
    piece = "".join(f"line {k} of a very long text with number {k * 7919}\n" for k in range(60_000))
    rows = [(1, piece), (2, piece[100_000:102_000]), (3, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    assert found[1].n_bytes == len(piece) and found[1].n_removed == 0 and found[2].n_removed == 2000
    assert {r.doc_id: r.n_words for r in quality.text_statistics(df).collect()}[1] == len(piece.split())
    words = piece.split()
    assert {r.doc_id: r.n_shingles for r in jaccard.near_duplicates(df).collect()}[1] == len({tuple(words[k : k + 4]) for k in range(len(words) - 3)})
    lines = {r.row.doc_id: r.n_runs for r in line_dedup.mark_repeated_lines(df).collect()}
    assert lines[1] is None and lines[2] == 1


def test_search_ignores_other_columns(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(0, 200, 10)], "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in (*EXTRA, "dimension", "ids", "score", "query_id", "least")})
    assert topk.top_k(topk.integer_vectors(df), F.expr("vec_id % 50 = 0")).count() == 20
