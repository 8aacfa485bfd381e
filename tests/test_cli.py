"""The stages from TSV files to a packaged result, incremental matching, and similarities against their definitions."""

import math
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinspark import cli
from kinspark.config import Blocking, Config, Decision, Model, Paths
from kinspark.functions import phonetic, similarity
from kinspark.functions.normalize import normalize
from kinspark.operators import sampling, tfidf
from kinspark.sources import tables
from kinspark.streaming.incremental import match_stream

NAMES = ("Alpine Tool Works", "Borealis Café", "Cobalt Shipping", "Delta Grain Mills", "Ember Glass House", "Fjord Net Makers", "Granite Stone Yard", "Harbor Light Co")


def write_split(folder, split, n):
    folder.mkdir(parents=True)
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    rows = {k: [header] for k in (1, 2, 3)}
    truth = ["source1_entity_id\tmatched_entity_ids\n"]
    for i in range(n):
        name, other = NAMES[i % len(NAMES)], NAMES[(i + 3) % len(NAMES)]
        rows[1].append(f"S1-{i:03}\t{name} {i // 8} Ltd\t{i + 1} Main St, Austin TX {70000 + i}\tUS\n")
        rows[2].append(f"S2-{i:03}\t{name} {i // 8} Limited\t{i + 1} Main Street Austin TX {70000 + i}\tUS\n")
        rows[3].append(f"S3-{i:03}\t{other} {i}\t{i + 500} Side Rd, Dallas TX {60000 + i}\tUS\n")
        truth.append(f"S1-{i:03}\t{f'S2-{i:03}' if i % 3 else ''}\n")
    for k, lines in rows.items():
        (folder / f"{split}_source{k}.tsv").write_text("".join(lines))
    (folder / "train_ground_truth.tsv").write_text("".join(truth))


def test_all_stages(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    write_split(tmp_path / "train", "train", 48)
    write_split(tmp_path / "test", "test", 24)
    paths = Paths(train_dir=str(tmp_path / "train"), test_dir=str(tmp_path / "test"), output_dir=str(tmp_path / "output"), cache_dir=str(tmp_path / "cache"), model_path=str(tmp_path / "cache/model"))
    cfg = Config(paths=paths, model=Model(n_estimators=60, learning_rate=0.2, num_leaves=7, min_child_samples=5, n_folds=2, calibrate=False, tfidf_min_df=1), decision=Decision())
    cli.run_stages(spark, cfg)
    matches = {r.s1_id: r.ids for r in tables.read_lists(spark, str(tmp_path / "output/matching_results.tsv"), "matched_entity_ids").collect()}
    assert len(matches) == 24 and sum(matches[f"S1-{i:03}"] == [f"S2-{i:03}"] for i in range(24)) >= 12
    assert cli.validate(cli.Run(spark, cfg)).count() == 0
    with zipfile.ZipFile(tmp_path / "myteam_submission.zip") as z:
        assert any(n.startswith("output/matching_results.tsv") for n in z.namelist()) and "code/kinspark/cli.py" in z.namelist()
    with pytest.raises(KeyError):
        cli.run_stages(spark, cfg, ["nothing"])


def test_stream_of_new_entities(spark, tmp_path):
    columns = "entity_id string, business_name string, business_address string, country string"
    others = normalize(spark.createDataFrame([(f"S2-{k}", n, "", "") for k, n in enumerate(NAMES)] + [(f"S3-{k}", n, "", "") for k, n in enumerate(NAMES)], columns))
    for k in (0, 1):
        spark.createDataFrame([(f"S1-{k}", NAMES[k] + " Inc", "", "")], columns).write.mode("append").parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    match_stream(arriving, others, Blocking(), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {(r.s1_id, r.cand_id) for r in spark.read.parquet(str(tmp_path / "out")).select("s1_id", "cand_id").collect()}
    assert {("S1-0", "S2-0"), ("S1-0", "S3-0"), ("S1-1", "S2-1"), ("S1-1", "S3-1")} <= got


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b, 1):
        out.append(row[j - 1] + 1 if x == y else max(row[j], out[-1]))
    return out


def indel(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def partial(a, b):
    """Every stretch of the longer string up to the shorter one's length that lies at an end or has that length."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return float(not b)
    sides = [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]
    return max(indel(s, t[i:j]) for s, t in sides for i in range(len(t) + 1) for j in range(i, len(t) + 1) if j - i == len(s) or j - i < len(s) and (i == 0 or j == len(t)))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 1.0
    one, two = (both + " " + left).strip(), (both + " " + right).strip()
    return max([indel(one, two)] + ([indel(both, one), indel(both, two)] if both else []))


def weighted(a, b):
    if not a or not b:
        return 0.0
    order = lambda s: " ".join(sorted(s.split()))
    wide = max(len(a), len(b)) / min(len(a), len(b))
    if wide < 1.5:
        return max(indel(a, b), 0.95 * indel(order(a), order(b)), 0.95 * token_set(a, b))
    scale = 0.9 if wide <= 8 else 0.6
    x, y = set(a.split()), set(b.split())
    tokens = 0.0 if not x or not y else 1.0 if x & y else max(partial(order(a), order(b)), partial(" ".join(sorted(x - y)), " ".join(sorted(y - x))))
    return max(indel(a, b), scale * partial(a, b), 0.95 * scale * tokens)


@settings(max_examples=300, deadline=None)
@given(st.text("abcd ", max_size=14), st.text("abcd ", max_size=14))
def test_similarities_by_their_definitions(a, b):
    got = similarity.name_similarities(a, b)
    order = lambda s: " ".join(sorted(s.split()))
    want = (indel(a, b), partial(a, b), indel(order(a), order(b)), token_set(a, b), weighted(a, b))
    assert all(abs(x - y) < 1e-12 for x, y in zip(got, want, strict=True)), (got, want)
    assert similarity.address_similarities(a, b, b, a) == pytest.approx((want[0], want[2], want[3]))


def test_first_fit_skips_and_goes_on(spark):
    sizes = {"S1-1": 4, "S1-2": 5, "S1-3": 0, "S1-4": 3, "S1-5": 2, "S1-6": 1, "S1-7": 0, "S1-8": 1, "S1-9": 6}
    queries = spark.createDataFrame([(k,) for k in sizes], "entity_id string")
    pairs = spark.createDataFrame([(k, f"S2-{j}") for k, n in sizes.items() for j in range(n)], "s1_id string, cand_id string")
    truth = spark.createDataFrame([("S1-9", "S2-0")], "s1_id string, cand_id string")

    def walk(budget):
        spent, kept = sizes["S1-9"], {"S1-9"}
        for k, n in sizes.items():
            if k != "S1-9" and spent < budget and spent + n <= budget:
                kept.add(k)
                spent += n
        return kept

    for budget in (3, 6, 8, 11, 13, 14, 16, 22, 50):
        assert {r.s1_id for r in sampling.budget_sample(queries, pairs, truth, budget, seed=None).collect()} == walk(budget), budget
        hashed = sampling.budget_sample(queries, pairs, truth, budget).agg({"n_pairs": "sum"}).first()[0]
        assert hashed <= max(budget, 6)


def test_fit_sample_is_cut_at_its_limit(spark):
    rows = spark.range(5000).selectExpr("'test' AS split", "cast(1 + id % 2 AS int) AS source", "concat('S', id) AS entity_id")
    found = tfidf.fit_sample(rows, 300)
    assert {tuple(r) for r in found.groupBy("source").count().collect()} == {(1, 300), (2, 300)}
    assert tfidf.fit_sample(rows, 10_000).count() == 5000 and found.select("entity_id").distinct().count() == 600


def test_metaphone_codes():
    """Words with the codes that the published rules give them."""
    want = {"thumb": "0M", "science": "SNS", "school": "SKL", "bridge": "BRJ", "night": "NT", "sign": "SN", "phone": "FN", "quick": "KK", "whale": "WL", "xavier": "SFR", "box": "BKS", "nation": "NXN", "ship": "XP", "cell": "SL", "catch": "KX", "zebra": "SBR", "happy": "HP"}
    assert {w: phonetic.metaphone(w) for w in want} == want


def test_model_is_saved_and_loaded(spark, tmp_path):
    from kinspark.operators import model
    from kinspark.operators.features import FEATURES

    rows = [(f"S1-{k // 4}", f"S2-{k}", *(float((k * 5 + j) % 7) for j in range(len(FEATURES))), int(k % 3 == 0)) for k in range(60)]
    pairs = spark.createDataFrame(rows, ["s1_id", "cand_id", *FEATURES, "label"]).coalesce(1)
    made = model.train(pairs, Model(n_estimators=2, num_leaves=3, calibrate=True, min_child_samples=1))
    made.save(str(tmp_path / "m"))
    back = model.Matcher.load(str(tmp_path / "m"))
    one, two = ({(r.s1_id, r.cand_id): round(r.p, 9) for r in m.score(pairs).collect()} for m in (made, back))
    assert one == two and len(one) == 60


def test_trees_grow_leaf_by_leaf_with_l2():
    """One tree of two leaves splits where a search over all cuts does; its leaves are -G / (H + L2), by the learning rate."""
    import numpy as np

    from kinspark.operators import boosting

    rng = np.random.default_rng(1)
    x, noise = rng.integers(0, 30, (300, 3)).astype(float), rng.random(300)
    y = ((x[:, 1] > 12) ^ (noise < 0.1)).astype(float)
    cfg = Model(n_estimators=1, learning_rate=0.5, num_leaves=2, min_child_samples=10, reg_lambda=3.0, colsample_bytree=1.0)
    made = boosting.fit_trees(x, y, cfg)
    p = y.mean()
    g, h = p - y, np.full(300, p * (1 - p))
    gains = {}
    for k in range(3):
        for cut in np.unique(x[:, k])[:-1]:
            low = x[:, k] <= cut
            if min(low.sum(), (~low).sum()) >= 10:
                gains[k, cut] = sum(g[s].sum() ** 2 / (h[s].sum() + 3.0) for s in (low, ~low))
    k, cut = max(gains, key=gains.get)
    assert made.feature[0][0] == k and cut < made.cut[0][0] < cut + 1
    low = x[:, k] <= cut
    want = np.where(low, -0.5 * g[low].sum() / (h[low].sum() + 3.0), -0.5 * g[~low].sum() / (h[~low].sum() + 3.0)) + math.log(p / (1 - p))
    assert np.allclose(made.raw(x), want)
    deep = boosting.fit_trees(x, y, Model(n_estimators=20, num_leaves=8, min_child_samples=5))
    assert all((f < 0).sum() <= 8 for f in deep.feature) and ((deep.probability(x) > 0.5) == (y > 0.5)).mean() > 0.85
    assert np.allclose(boosting.Calibrated.from_bytes(boosting.Calibrated(deep).to_bytes()).probability(x), deep.probability(x))


def test_isotonic_never_falls():
    import numpy as np

    from kinspark.operators import boosting

    where, level = boosting.fit_isotonic(np.array([0.1, 0.2, 0.2, 0.3, 0.4, 0.5]), np.array([0.0, 1.0, 0.0, 0.0, 1.0, 1.0]))
    assert where.tolist() == [0.1, 0.2, 0.3, 0.4, 0.5] and np.allclose(level, [0.0, 1 / 3, 1 / 3, 1.0, 1.0])
