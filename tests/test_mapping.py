import itertools

import pytest
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.operators import cascade, classifier, diagnostics, evaluate, gates, taxonomy, training, views
from tallyspark.plans import jobs

RAW = "voucher_id string, vch_desc string, vch_type string, category_id string"


def approved(spark, rows):
    return spark.createDataFrame(rows, "description string, vch_type string, canonical_family string, canonical_id int")


def test_approved_ids_force_the_family(spark):
    raw = spark.createDataFrame([("1", "Milk", "Transfer", None), ("2", "milk", "Expense", "3")], RAW)
    rows = {r.voucher_id: r for r in jobs.first_pass(raw, lookups.approved_mappings(spark)).collect()}
    # a v1 Groceries id is read as v2 Other
    assert (rows["1"].canonical_id, rows["1"].canonical_family, rows["1"].mapping_method) == (2009, "Other", "APPROVED_MAPPING")
    assert (rows["2"].canonical_family, rows["2"].mapping_method) in {("Food & Groceries", "RULE"), ("Other", "APPROVED_MAPPING")}
    moved = cascade.crosswalk_ids(cascade.approved_lookup(lookups.approved_mappings(spark)))
    fixed = cascade.resolve(cascade.with_approved(cascade.clean_inputs(raw), moved)).filter("voucher_id = '1'").first()
    assert fixed.canonical_family == "Food & Groceries"


def test_conflicting_approved_rows_stop(spark):
    bad = approved(spark, [("A", "Income", "Fuel", 2002), (" a ", "income", "Fuel", 2003)])
    with pytest.raises(gates.GateError):
        cascade.approved_lookup(bad)


@pytest.mark.parametrize("stages", list(itertools.product([False, True], repeat=4)))
def test_cascade_precedence(spark, stages):
    has_approved, has_rule, has_strong, has_ml = stages
    df = spark.createDataFrame(
        [(
            "Income" if has_rule else None,
            2002 if has_approved else None, "Fuel" if has_approved else None,
            "Transport" if has_strong else None,
            "Healthcare" if has_ml else None, 0.9, 0.5,
        )],
        "rule_family string, approved_id int, approved_family string, strong_family string,"
        " ml_family string, ml_confidence double, ml_margin double",
    )
    row = cascade.resolve(df).first()
    order = [(has_approved, "APPROVED_MAPPING", "Fuel"), (has_rule, "RULE", "Income"),
             (has_strong, "CATEGORY_ID", "Transport"), (has_ml, "ML", "Healthcare"), (True, "UNMAPPED", "UNMAPPED")]
    method, family = next((m, f) for on, m, f in order if on)
    assert (row.mapping_method, row.canonical_family) == (method, family)
    assert (row.ml_confidence is not None) == (method == "ML")
    assert row.canonical_mapping_status == ("UNMAPPED" if method == "UNMAPPED" else "MAPPED")


def test_strength_tiers(spark):
    df = spark.createDataFrame([(95.0,), (94.99,), (80.0,), (79.9,), (60.0,), (59.9,)], "p double")
    got = [r.t for r in df.select(cascade.strength_tier(F.col("p")).alias("t")).collect()]
    assert got == ["STRONG", "MODERATE", "MODERATE", "WEAK", "WEAK", "AMBIGUOUS"]


def test_dominant_family_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("1", "RULE", "Fuel", "5"), ("2", "RULE", "Income", "5.0"), ("3", "ML", "Other", "5"),
         ("4", "RULE", "Income", None), ("5", "RULE", "UNMAPPED", "5")],
        "voucher_id string, mapping_method string, canonical_family string, category_id string",
    )
    rows = {r.category_id_clean: r for r in cascade.dominant_family(cascade.category_family_matrix(df)).collect()}
    assert rows[5.0].dominant_canonical_family == "Fuel" and rows[5.0].mapped_total == 2
    assert rows[-1.0].dominant_canonical_family == "Income"


def test_canonical_category(spark):
    df = spark.createDataFrame(
        [("petrol", 5, "Expense"), ("petrol", 6, "Expense"), ("cash", 2, "Transfer"), ("atm", 1, "Income")],
        "clean_description string, source_category_id long, vch_type string",
    )
    got = cascade.canonical_category(df, lookups.category_mappings(spark), lookups.contextual_rules(spark))
    assert {(r.clean_description, r.source_category_id): r.canonical_category for r in got.collect()} == {
        ("petrol", 5): 2002, ("petrol", 6): 6, ("cash", 2): 2007, ("atm", 1): 2007}


def test_categorization_rows(spark):
    df = spark.createDataFrame([("1", None, "Fuel", "UNMAPPED"), ("2", 2002, "Fuel", "MAPPED")],
                               "voucher_id string, canonical_id int, canonical_family string, canonical_mapping_status string")
    rows = {r.voucher_id: r for r in views.categorization_rows(df).collect()}
    assert rows[1].category_name == "UNMAPPED" and rows[2].category_name == "Fuel"
    assert rows[2].matched_term is None and rows[2].classification_method is None


def test_training_set_rules(spark):
    rows = [("a", 2002, 1, "approved_mapping"), ("a", 2002, 2, "deterministic_rule"), ("b", 2002, 3, "deterministic_rule"),
            ("b", 2003, 4, "deterministic_rule"), ("c", 2003, 5, "deterministic_rule"), ("d", 2003, 6, "deterministic_rule")]
    union = spark.createDataFrame(
        [(v, d, "Expense", i, "x", s, "high", s, d) for d, i, v, s in rows],
        "voucher_id long, vch_desc string, vch_type string, canonical_id int, canonical_family string,"
        " label_source string, label_confidence string, validation_status string, normalized_desc string",
    )
    got = {(r.normalized_desc, r.canonical_id, r.label_source) for r in training.training_set(union).collect()}
    assert got == {("a", 2002, "approved_mapping"), ("c", 2003, "deterministic_rule"), ("d", 2003, "deterministic_rule")}
    assert training.training_set(union, cap=1).count() == 2


def test_hash_split_and_cap_are_reproducible(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("label"))
    shares = training.hash_split(df, "k").filter("is_test").count() / 5000
    assert 0.17 < shares < 0.23
    a = {r.k for r in training.capped(df, "label", "k", 100).collect()}
    b = {r.k for r in training.capped(df.repartition(7), "label", "k", 100).collect()}
    assert a == b and len(a) == 200
    strat = training.stratified_split(df, "k", "label").filter("is_test").groupBy("label").count().collect()
    assert {r["count"] for r in strat} == {500}


# A held-out confusion matrix with its published report.
LABELS = ["Food & Groceries", "Fuel", "Healthcare", "Income", "Other", "Shopping & Retail",
          "Transfers & Withdrawals", "Transport", "Utilities & Bills"]
MATRIX = [
    [381, 1, 0, 0, 14, 1, 0, 1, 2],
    [1, 106, 0, 0, 0, 0, 0, 0, 0],
    [7, 0, 177, 0, 0, 0, 0, 1, 0],
    [1, 0, 0, 127, 0, 0, 1, 0, 0],
    [3, 0, 0, 0, 1, 0, 0, 0, 0],
    [1, 0, 0, 0, 0, 138, 0, 0, 0],
    [1, 0, 0, 0, 0, 0, 149, 0, 0],
    [3, 0, 0, 0, 0, 1, 0, 95, 0],
    [0, 0, 0, 0, 0, 0, 0, 0, 82],
]
REPORT = {"Food & Groceries": (0.96, 0.95, 0.95, 400), "Fuel": (0.99, 0.99, 0.99, 107), "Healthcare": (1.00, 0.96, 0.98, 185),
          "Income": (1.00, 0.98, 0.99, 129), "Other": (0.07, 0.25, 0.11, 4), "Shopping & Retail": (0.99, 0.99, 0.99, 139),
          "Transfers & Withdrawals": (0.99, 0.99, 0.99, 150), "Transport": (0.98, 0.96, 0.97, 99),
          "Utilities & Bills": (0.98, 1.00, 0.99, 82), "macro avg": (0.88, 0.90, 0.88, 1295), "weighted avg": (0.98, 0.97, 0.97, 1295)}


def test_class_report_matches_published_matrix(spark):
    cells = [(a, p, MATRIX[i][j]) for i, a in enumerate(LABELS) for j, p in enumerate(LABELS)]
    counts = spark.createDataFrame(cells, "actual string, prediction string, n long")
    rows = {r.label: r for r in evaluate.class_report(counts).collect()}
    for label, (p, r, f, s) in REPORT.items():
        got = rows[label]
        assert (round(got.precision, 2), round(got.recall, 2), round(got.f1_score, 2), got.support) == (p, r, f, s)
    assert round(rows["accuracy"].precision, 4) == 0.9699


def test_top2_and_grid(spark):
    df = spark.createDataFrame(
        [(["a", "b", "c"], [0.2, 0.6, 0.2], "b"), (["a", "b", "c"], [0.5, 0.5, 0.0], "b"), (["a"], [1.0], "a")],
        "classes array<string>, probabilities array<double>, actual string",
    )
    rows = evaluate.top2(df).collect()
    assert [(r.prediction, r.second_prediction) for r in rows] == [("b", "a"), ("a", "b"), ("a", None)]
    assert [r.second_confidence for r in rows] == [0.2, 0.5, 0.0]
    assert evaluate.top2(df, single_class_repeats=True).collect()[2].second_prediction == "a"
    grid = evaluate.threshold_grid(evaluate.top2(df)).collect()
    assert len(grid) == 60
    by = {(g.confidence_threshold, g.margin_threshold): g for g in grid}
    assert by[(0.5, 0.0)].accepted_predictions == 3 and by[(0.95, 0.25)].accepted_predictions == 1
    for c, m in by:  # tighter thresholds never accept more
        assert all(by[(c, m)].accepted_predictions >= by[(c2, m2)].accepted_predictions for c2, m2 in by if c2 >= c and m2 >= m)
    best = evaluate.recommend(evaluate.threshold_grid(evaluate.top2(df))).first()
    assert best.reaches_target and best.confidence_threshold == 0.5 and best.margin_threshold == 0.05


def reference_fit(texts, labels, ask):
    """The same objective minimized densely: balanced log loss plus half the squared weights."""
    import numpy as np

    def grams(t):
        w = [x for x in t.split() if len(x) >= 2]
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    docs = [grams(t) for t in texts]
    df = {}
    for d in docs:
        for g in set(d):
            df[g] = df.get(g, 0) + 1
    vocabulary = sorted(g for g in df if df[g] <= 0.98 * len(docs))
    idf = np.array([np.log((1 + len(docs)) / (1 + df[g])) + 1 for g in vocabulary])

    def vector(d):
        tf = np.array([d.count(g) for g in vocabulary], dtype=float)
        v = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) * idf
        return v / (np.linalg.norm(v) or 1.0)

    x = np.stack([vector(d) for d in docs])
    classes = sorted(set(labels))
    y = np.array([[c == label for c in classes] for label in labels], dtype=float)
    weight = len(y) / (len(classes) * y.sum(0))[y.argmax(1)]
    w, b = np.zeros((x.shape[1], len(classes))), np.zeros(len(classes))
    for _ in range(20000):
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d = (p - y) * weight[:, None] / len(y)
        w -= 1.0 * (x.T @ d + w / len(y))
        b -= 1.0 * d.sum(0)
    z = np.stack([vector(grams(t)) for t in ask]) @ w + b
    p = np.exp(z - z.max(1, keepdims=True))
    return classes, p / p.sum(1, keepdims=True)


def test_classifier_fit_save_load(spark, tmp_path):
    words = {"Fuel": ["petrol", "diesel pump", "fuel station"], "Income": ["salary", "monthly wages", "bonus pay"],
             "Other": ["petrol bonus", "misc"]}
    triples = [(f"{f}-{w}-{i}", f"{w} {i}x", f) for f, ws in words.items() for w in ws for i in range(4)]
    rows = spark.createDataFrame(triples, "row_id string, text string, label string")
    model = classifier.fit(rows)
    model.save(str(tmp_path / "m"))
    loaded = classifier.load_or_fit(spark, str(tmp_path / "m"), rows)
    asks = ["petrol", "wages", "zzz", "petrol petrol bonus"]
    texts = spark.createDataFrame([(t,) for t in asks], "text string")
    scored = evaluate.top2(classifier.probabilities(loaded, texts))
    out = {r.text: r for r in scored.collect()}
    assert out["petrol"].prediction == "Fuel" and out["wages"].prediction == "Income"
    classes, expected = reference_fit([t for _, t, _ in triples], [f for _, _, f in triples], asks)
    assert out["zzz"].classes == classes
    for text, p in zip(asks, expected):
        assert abs(sum(out[text].probabilities) - 1) < 1e-9
        assert out[text].probabilities == pytest.approx(list(p), abs=5e-3)
    picked = {r.text: r.ml_family for r in classifier.accepted_families(scored, 0.4, 0.1).collect()}
    assert picked["petrol"] == "Fuel" and picked["zzz"] is None


def test_proposal_summary_and_unresolved_reports(spark):
    labelled = spark.createDataFrame(
        [("petrol", "Expense", 5)] * 11 + [("petrol", "Expense", 6)] + [("sabzi", "Expense", 7)],
        "clean_description string, vch_type string, source_category_id long",
    )
    rows = {r.description: r for r in taxonomy.proposal_groups(labelled).collect()}
    assert rows["petrol"].dominant_source_category_id == 5 and rows["petrol"].source_category_purity == 0.9167
    assert rows["petrol"].risk_level == "REVIEW_CANDIDATE" and rows["sabzi"].possible_synonym == "vegetables"
    open_rows = spark.createDataFrame(
        [(None, "UNMAPPED"), (" nan ", None), ("abc", " "), ("abc def", "Fuel")], "vch_desc string, canonical_family string"
    )
    left = diagnostics.unresolved(open_rows)
    assert left.count() == 3 and diagnostics.blank_share(left).first().blank == 2
    bands = {r.length_band: r.transaction_count for r in diagnostics.length_bands(left).collect()}
    assert bands == {"0 characters": 1, "1-5 characters": 2}


def test_map_transactions_end_to_end(spark, sf_dir, tmp_path):
    from tallyspark.checks import adapter

    raw = adapter.raw(spark, sf_dir)
    mapped = jobs.map_transactions(raw, lookups.approved_mappings(spark), str(tmp_path / "model"))
    out = mapped.categorized.groupBy("mapping_method").count().collect()
    assert sum(r["count"] for r in out) == raw.count()
    names = jobs.build_views(adapter.production(spark, sf_dir), mapped.categorized, str(tmp_path / "views"))
    assert len(names) == 8
    assert spark.read.parquet(str(tmp_path / "views" / "vw_category_summary")).count() >= 5


@pytest.mark.parametrize("name", ["D2_blank_share", "G15_stratified_split"])
def test_rows_read_once_are_not_written(spark, tmp_path, monkeypatch, name):
    """the categorized rows go straight into a report that reads them once."""
    from tallyspark import checks
    from tallyspark.checks import mapping

    orders = ["id AS o_orderkey", "id % 50 AS o_custkey", "split('F O P', ' ')[int(id % 3)] AS o_orderstatus", "double(id) AS o_totalprice", "date'1998-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"]
    spark.range(500).selectExpr(*orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(20).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "int(id) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    written = []
    plain = mapping.materialized
    monkeypatch.setattr(mapping, "materialized", lambda df, label: written.append(label) or plain(df, label))
    rows = checks.all_checks()[0][name](spark, str(tmp_path)).collect()
    assert rows and "categorized" not in written
