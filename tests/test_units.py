"""Hand-written cases of the record-linkage functions."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinspark.config import Decision, load_config
from kinspark.functions import normalize, phonetic, similarity
from kinspark.operators import checks, decide
from kinspark.sources import tables


def entity(spark, name="", address="", country=""):
    return normalize.normalize(spark.createDataFrame([("S2-1", name, address, country)], "entity_id string, business_name string, business_address string, country string")).first()


def test_names(spark):
    r = entity(spark, "Intl & Co. Tech, L.L.C.")
    assert (r.name_full, r.name_no_legal, r.name_init) == ("international and co technology l l c", "international technology l l c", "itllc")
    assert entity(spark, "The Company Ltd").name_no_legal == ""
    assert entity(spark, "Café_1 हिन्दी").name_raw.startswith("café_1")
    assert entity(spark, None).name_raw == ""


def test_addresses(spark):
    r = entity(spark, address="12 Main St, Miami FL 33101")
    assert (r.addr_full, r.state, r.city, r.zip5, r.house_no) == ("12 main street miami floor 33101", "", "", "33101", "12")
    r = entity(spark, address="nr Park, San Francisco CA 94105-1234")
    assert (r.is_landmark, r.state, r.city) == (1, "ca", "francisco")
    r = entity(spark, address="CA 560001")
    assert (r.state, r.city, r.pincode, r.house_no) == ("ca", "", "560001", "560001")


def test_unicode_forms(spark):
    df = spark.createDataFrame([("S2-1", "Ｔｅｃｈ ﬁrm", "", "")], "entity_id string, business_name string, business_address string, country string")
    assert normalize.normalize(df, unicode_forms=True).first().name_full == "technology firm"


def test_metaphone():
    assert [phonetic.metaphone(w) for w in ("Phone", "Wrack", "Knee", "Fashion", "")] == ["FN", "RK", "N", "FXN", ""]


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_similarities_in_range_and_symmetric(a, b):
    for f in (similarity.ratio, similarity.partial_ratio, similarity.token_sort_ratio, similarity.token_set_ratio, similarity.weighted_ratio):
        assert 0 <= f(a, b) <= 1 and abs(f(a, b) - f(b, a)) < 1e-12
    assert similarity.ratio(a, a) == 1


def test_token_set():
    assert similarity.token_set_ratio("a b c", "c b") == 1.0
    assert similarity.token_set_ratio("", "a") == 0.0


def test_tsv(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\textra\tbusiness_name\tbusiness_address\tcountry\nS1-1\tx\tNA\t"Q, uoted ""x"""\tnull\nS1-2\ty\tNone\t\tIN\n')
    got = [tuple(r) for r in tables.read_entities(spark, str(tmp_path / "a.tsv")).orderBy("entity_id").collect()]
    assert got == [("S1-1", "", 'Q, uoted "x"', ""), ("S1-2", "", "", "IN")]
    (tmp_path / "b.tsv").write_text("entity_id\nS1-1\n")
    with pytest.raises(ValueError):
        tables.read_entities(spark, str(tmp_path / "b.tsv"))
    with pytest.raises(FileNotFoundError):
        tables.read_sources(spark, str(tmp_path), "train")


def test_truth_and_lists(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,, S3-1\nS1-2\t\n")
    assert {r.s1_id: r.ids for r in tables.read_truth(spark, str(tmp_path / "t.tsv")).collect()} == {"S1-1": ["S2-1", " S3-1"], "S1-2": []}
    lists = spark.createDataFrame([("S1-2", []), ("S1-1", ["S3-1", "S2-1"])], "s1_id string, ids array<string>")
    tables.write_results(lists, str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*"))
    assert part.read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS3-1,S2-1\nS1-2\t\n"


def picks(spark, scored, *args, **kw):
    df = spark.createDataFrame([("S1-1", [{"p": p, "cand_id": c} for p, c in scored])], "s1_id string, scored array<struct<p:double,cand_id:string>>")
    return df.select(decide.greedy_picks(F.col("scored"), *args, **kw).alias("x")).first().x


def test_greedy(spark):
    assert picks(spark, [(0.9, "b"), (0.9, "a"), (0.8, "c")], 0.5, 0.2) == ["b", "a"]
    assert picks(spark, [(0.4, "a")], 0.5, 0.2) == []
    assert picks(spark, [(0.9, "b"), (0.9, "a")], 0.5, 0.2, 1) == ["b", "a"]
    assert picks(spark, [(0.9, "b"), (0.9, "a")], 0.5, 0.2, 1, mode="fixed") == ["b"]


def test_f05(spark):
    row = lambda *v: spark.range(1).select(decide.f05(*map(F.lit, v)).alias("x")).first().x
    assert abs(row(2, 1, 1) - 0.625 / 1.125) < 1e-12
    assert (row(0, 0, 0), row(1, 0, 0), row(0, 1, 0)) == (1.0, 0.0, 0.0)


def test_grid():
    assert sum(len(decide.grid(0.20, o, 0.02)) for o in decide.grid(*Decision().t_open_grid)) == 726


def test_checks_find_nothing_in_a_good_result(spark):
    q = spark.createDataFrame([("S1-1",)], "entity_id string")
    o = spark.createDataFrame([("S2-1",)], "entity_id string")
    m = spark.createDataFrame([("S1-1", ["S2-1"])], "s1_id string, ids array<string>")
    c = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cand_id string")
    assert checks.problems(m, c, q, o).count() == 0


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("blocking: {char_ngram_n: 4, nothing: 1}\nteam_name: x\n")
    cfg = load_config(str(tmp_path / "c.yaml"))
    assert (cfg.blocking.char_ngram_n, cfg.blocking.rare_token_df_max, cfg.team_name) == (4, 200, "x")


def test_least_hash_keys(spark):
    """Equal names share all bands, near names most often one, unlike names none; off by default."""
    from kinspark.config import Blocking
    from kinspark.operators import blocking

    names = ["northern lights trading house", "northern lights trading house", "northern light trading houses", "quick brown fox jumpers"]
    rows = spark.createDataFrame([(f"S2-{k}", n, "", "") for k, n in enumerate(names)], "entity_id string, business_name string, business_address string, country string")
    found = blocking.key_rows(normalize.normalize(rows), Blocking(use_lsh=True)).where("key like 'lsh:%'").collect()
    keys = [{r.key for r in found if r.entity_id == f"S2-{k}"} for k in range(4)]
    assert len(keys[0]) == 4 and keys[0] == keys[1] and keys[0] & keys[2] and not keys[0] & keys[3]
    assert blocking.key_rows(normalize.normalize(rows), Blocking()).where("key like 'lsh:%'").count() == 0
