"""Relational building blocks, proposals, the mapping cascade and the analytics views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.checks import adapter, oracle
from tallyspark.checks.oracle import quoted, sql
from tallyspark.checks.registry import query
from tallyspark.functions import values
from tallyspark.functions.quantiles import exact_quantiles
from tallyspark.operators import cascade, clean, diagnostics, evidence, gates, taxonomy, training, views
from tallyspark.plans import jobs
from tallyspark.session import materialized
from tallyspark.sources import sinks


def pass1(spark, sf):
    return jobs.first_pass(adapter.raw(spark, sf), lookups.approved_mappings(spark))


def dominant(spark, sf):
    return jobs.category_table(pass1(spark, sf))


def categorized(spark, sf):
    """The cascade without the classifier, as the table its reports read."""
    return materialized(cascaded(spark, sf), "categorized")


def cascaded(spark, sf):
    return jobs.categorize(adapter.raw(spark, sf), lookups.approved_mappings(spark))


def categorization(spark, sf):
    return views.categorization_rows(categorized(spark, sf))


def labelled(spark, sf):
    return clean.sane_labelled(adapter.raw(spark, sf)).withColumn(
        "voucher_id", F.col("voucher_id").cast("long")
    )


MEAN = "CAST(sum({0}) AS DOUBLE) / count({0})"

# ---------------------------------------------------------------------------- joins

_DETAIL = """p.voucher_id, p.consumer_id, CAST(p.transaction_date AS VARCHAR) AS transaction_date, p.transaction_year,
  p.transaction_month, p.transaction_type, CAST(p.amount AS DOUBLE) AS amount, p.description, tc.canonical_id,
  coalesce(tc.category_name, 'UNMAPPED') AS category_name, tc.mapping_status, tc.classification_method,
  tc.matched_term, tc.confidence, tc.label_source"""


@query(
    "J1_left_equi",
    sql(["prod", "tc"], "SELECT p.voucher_id, coalesce(tc.category_name, 'UNMAPPED') AS category_name FROM prod p LEFT JOIN tc USING (voucher_id)"),
)
def j1(spark, sf):
    return views.transactions_with_category(
        adapter.production(spark, sf), categorization(spark, sf)
    ).select("voucher_id", "category_name")


@query(
    "J2_lookup_description_type",
    sql(["first_pass"], "SELECT voucher_id, description_clean, vch_type_clean, approved_id FROM first_pass"),
)
def j2(spark, sf):
    lookup = cascade.approved_lookup(lookups.approved_mappings(spark))
    return cascade.with_approved(cascade.clean_inputs(adapter.raw(spark, sf)), lookup).select(
        "voucher_id", "description_clean", "vch_type_clean", "approved_id"
    )


@query(
    "J3_lookup_category_id",
    sql(["cleaned", "strong"], "SELECT voucher_id, category_id_clean, strong_family FROM cleaned LEFT JOIN strong USING (category_id_clean)"),
)
def j3(spark, sf):
    strong = cascade.strong_categories(dominant(spark, sf))
    return cascade.with_strong_category(cascade.clean_inputs(adapter.raw(spark, sf)), strong).select(
        "voucher_id", "category_id_clean", "strong_family"
    )


@query(
    "J4_lookup_description",
    sql(["test", "history"], "SELECT voucher_id, category AS hist_category FROM test LEFT JOIN history USING (clean_description)"),
)
def j4(spark, sf):
    rows = training.hash_split(labelled(spark, sf), "voucher_id")
    history = evidence.fit_history(rows.filter("not is_test"), category="source_category_id")
    return evidence.with_history(rows.filter("is_test"), history).select("voucher_id", "hist_category")


@query("J5_group_total", sql(["matrix"], "SELECT category_id_clean, canonical_family_clean, transaction_count, mapped_total FROM matrix"))
def j5(spark, sf):
    return cascade.category_family_matrix(pass1(spark, sf)).drop("percentage")


@query(
    "J6_anti_join",
    sql(["prod", "loaded"], "SELECT voucher_id FROM prod WHERE voucher_id NOT IN (SELECT voucher_id FROM loaded)"),
)
def j6(spark, sf):
    return (
        adapter.production(spark, sf)
        .select("voucher_id")
        .join(adapter.loaded(spark, sf).select("voucher_id"), "voucher_id", "left_anti")
    )


@query(
    "J7_semi_join",
    sql(
        ["labelled"],
        """SELECT voucher_id, clean_description FROM labelled WHERE clean_description IN
           (SELECT clean_description FROM labelled GROUP BY 1 HAVING count(DISTINCT source_category_id) > 1)""",
    ),
)
def j7(spark, sf):
    rows = labelled(spark, sf).select("voucher_id", "clean_description", "source_category_id")
    return gates.rows_in_conflict(rows, "clean_description", "source_category_id").drop("source_category_id")


@query(
    "J8_anti_conflicts",
    sql(
        ["labelled"],
        """SELECT voucher_id, clean_description FROM labelled WHERE clean_description NOT IN
           (SELECT clean_description FROM labelled GROUP BY 1 HAVING count(DISTINCT source_category_id) > 1)""",
    ),
)
def j8(spark, sf):
    rows = labelled(spark, sf).select("voucher_id", "clean_description", "source_category_id")
    return gates.rows_in_conflict(rows, "clean_description", "source_category_id", inside=False).drop("source_category_id")


_SEEDS = [
    (cid, term) for cid, terms in lookups.SEED_TERMS_V1.items() for term in terms
]


@query(
    "J9_term_containment",
    sql(
        ["labelled"],
        f"""SELECT clean_description, term, canonical_id FROM (SELECT DISTINCT clean_description FROM labelled),
            ({oracle.values_list(_SEEDS)}) AS t(canonical_id, term)
            WHERE contains(' ' || clean_description || ' ', ' ' || term || ' ')""",
    ),
)
def j9(spark, sf):
    texts = labelled(spark, sf).select("clean_description").distinct()
    terms = lookups.seed_terms(spark).select("term", "canonical_id")
    return evidence.contained_terms(texts, terms).select("clean_description", "term", "canonical_id")


@query(
    "J11_unresolved_strong",
    sql(
        ["pass1", "dominant"],
        """SELECT voucher_id, dominant_canonical_family FROM (SELECT *, coalesce(TRY_CAST(category_id AS DOUBLE), -1.0) AS cid FROM pass1) p
           LEFT JOIN (SELECT * FROM dominant WHERE dominant_percentage >= 95) d ON d.category_id_clean = p.cid
           WHERE canonical_family = 'UNMAPPED'""",
    ),
)
def j11(spark, sf):
    strong = cascade.small(
        dominant(spark, sf)
        .filter("mapping_strength = 'STRONG'")
        .select("category_id_clean", "dominant_canonical_family")
    )
    cid = F.coalesce(values.to_number(F.col("category_id"), "double"), F.lit(-1.0))
    rows = diagnostics.unresolved(pass1(spark, sf)).select("voucher_id", cid.alias("category_id_clean"))
    return rows.join(strong, "category_id_clean", "left").select("voucher_id", "dominant_canonical_family")


# ----------------------------------------------------------- aggregates and orderings


@query(
    "G1_group_aggregates",
    sql(
        ["prod"],
        f"""SELECT account_id, count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount, {MEAN.format('amount')} AS average_amount,
            CAST(min(amount) AS DOUBLE) AS minimum_amount, CAST(max(amount) AS DOUBLE) AS maximum_amount FROM prod GROUP BY 1""",
    ),
)
def g1(spark, sf):
    return adapter.production(spark, sf).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        values.mean(F.col("amount")).alias("average_amount"),
        F.min("amount").alias("minimum_amount"),
        F.max("amount").alias("maximum_amount"),
    )


@query(
    "G2_conditional_sum",
    sql(
        ["prod"],
        "SELECT account_id, "
        + ", ".join(
            f"CAST(sum(CASE WHEN transaction_type = '{t}' THEN amount ELSE 0 END) AS DOUBLE) AS {t.lower()}"
            for t in values.BATCH_TYPES
        )
        + " FROM prod GROUP BY 1",
    ),
)
def g2(spark, sf):
    kind, amount = F.col("transaction_type"), F.col("amount")
    return adapter.production(spark, sf).groupBy("account_id").agg(
        *[F.sum(values.amount_of(t, kind, amount)).alias(t.lower()) for t in values.BATCH_TYPES]
    )


@query(
    "G3_count_distinct",
    sql(
        ["prod"],
        "SELECT transaction_type, count(DISTINCT consumer_id) AS consumers, count(DISTINCT original_category_id) AS categories FROM prod GROUP BY 1",
    ),
)
def g3(spark, sf):
    return adapter.production(spark, sf).groupBy("transaction_type").agg(
        F.count_distinct("consumer_id").alias("consumers"),
        F.count_distinct("original_category_id").alias("categories"),
    )


@query(
    "G4_value_counts",
    sql(
        ["prod"],
        "SELECT use_case_title, count(*) AS transaction_count, count(*) / CAST((SELECT count(*) FROM prod) AS DOUBLE) * 100.0 AS share_pct FROM prod GROUP BY 1",
    ),
)
def g4(spark, sf):
    counts = cascade.counts_by(adapter.production(spark, sf), "use_case_title")
    return cascade.with_share(counts, "transaction_count", "share_pct", [])


@query("G5_argmax", sql(["dominant"], "SELECT category_id_clean, dominant_canonical_family, dominant_count FROM dominant"))
def g5(spark, sf):
    return dominant(spark, sf).select("category_id_clean", "dominant_canonical_family", "dominant_count")


@query(
    "G6_quantiles",
    sql(
        ["prod"],
        """SELECT round(quantile_cont(CAST(amount AS DOUBLE), 0.25), 4) AS q25, round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 4) AS q50,
           round(quantile_cont(CAST(amount AS DOUBLE), 0.75), 4) AS q75 FROM prod""",
    ),
)
def g6(spark, sf):
    df = adapter.production(spark, sf).select(F.col("amount").cast("double").alias("amount"))
    q = exact_quantiles(df, "amount", [0.25, 0.5, 0.75])
    return spark.range(1).select(*[F.round(F.lit(v), 4).alias(n) for n, v in zip(("q25", "q50", "q75"), q)])


@query(
    "G6_quantiles_by_refinement",
    """SELECT round(quantile_cont(value, 0.25), 4) AS q25, round(median(value), 4) AS q50, round(quantile_cont(value, 0.9), 4) AS q90 FROM events""",
)
def g6_refined(spark, sf):
    """The path for columns with more distinct values than one aggregate buffer should hold."""
    df = adapter.table(spark, sf, "events").select("value")
    q = exact_quantiles(df, "value", [0.25, 0.5, 0.9], distinct_limit=0)
    return df.agg(*[F.round(F.lit(v), 4).alias(n) for n, v in zip(("q25", "q50", "q90"), q)])


@query(
    "G7_having_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def g7(spark, sf):
    return (
        adapter.table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
    )


@query(
    "G8_drop_duplicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (
         PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def g8(spark, sf):
    rows = adapter.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]
    return sinks.first_per_key(rows, ["l_orderkey", "l_linenumber"], order)


@query(
    "G9_class_cap",
    sql(
        ["cat"],
        f"""SELECT canonical_family, voucher_id FROM (SELECT canonical_family, voucher_id, row_number() OVER (
             PARTITION BY canonical_family ORDER BY md5('42|' || voucher_id), voucher_id) AS rn FROM cat) WHERE rn <= {lookups.MAX_PER_CLASS}""",
    ),
)
def g9(spark, sf):
    rows = categorized(spark, sf).select("canonical_family", "voucher_id")
    return training.capped(rows, "canonical_family", "voucher_id")


@query(
    "G10_top_n",
    sql(["labelled"], "SELECT clean_description, count(*) AS transaction_count FROM labelled GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50"),
)
def g10(spark, sf):
    return diagnostics.top_counts(labelled(spark, sf), ["clean_description"], 50)


_RANK = "CASE risk_level WHEN 'SAFE_CANDIDATE' THEN 0 WHEN 'REVIEW_CANDIDATE' THEN 1 ELSE 2 END"


@query(
    "G11_custom_order",
    sql(
        ["proposals"],
        f"""SELECT description, vch_type, proposed_family, risk_level FROM proposals
            ORDER BY {_RANK}, transaction_support DESC, source_category_purity DESC, description, vch_type""",
    ),
)
def g11(spark, sf):
    ordered = taxonomy.review_order(taxonomy.proposal_groups(labelled(spark, sf)))
    return ordered.select("description", "vch_type", "proposed_family", "risk_level")


_UNION = f"""SELECT CAST(voucher_id AS BIGINT) AS voucher_id, vch_desc, canonical_id,
    CASE mapping_method WHEN 'RULE' THEN 'deterministic_rule' ELSE 'approved_mapping' END AS label_source,
    {oracle.p11('vch_desc')} AS normalized_desc
  FROM cat WHERE mapping_method IN ('APPROVED_MAPPING', 'RULE') AND canonical_family = {oracle.family_case('canonical_id')} AND {oracle.p11('vch_desc')} <> ''
  UNION ALL SELECT CAST(voucher_id AS BIGINT), vch_desc, 2006, 'human_validated_shopping', {oracle.p11('vch_desc')}
  FROM raw WHERE contains(lower(vch_desc), 'daraz')"""
oracle.part("label_union", ["cat", "raw"], _UNION)
oracle.part(
    "label_first",
    ["label_union"],
    """SELECT *, count(*) OVER (PARTITION BY normalized_desc) AS ids FROM (SELECT *, row_number() OVER (
         PARTITION BY normalized_desc, canonical_id ORDER BY CASE label_source WHEN 'approved_mapping' THEN 0
           WHEN 'deterministic_rule' THEN 1 ELSE 2 END, voucher_id) AS rn FROM label_union) WHERE rn = 1""",
)
oracle.part(
    "train_set",
    ["label_first"],
    f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY md5('42|' || normalized_desc), normalized_desc) AS pos
        FROM label_first WHERE ids = 1) WHERE pos <= {lookups.MAX_PER_CLASS}""",
)


def validation(spark, sf):
    """Stands for the human review of shopping rows."""
    rows = adapter.raw(spark, sf)
    return rows.select(
        F.col("voucher_id").cast("long").alias("voucher_id"),
        "vch_desc",
        F.when(F.lower("vch_desc").contains("daraz"), " strong_shopping ").otherwise("UNSURE").alias("validation_status"),
    )


def label_union(spark, sf, rows=None):
    return training.labelled_union(
        [training.trusted_rows(categorized(spark, sf) if rows is None else rows), training.validated_rows(validation(spark, sf))]
    )


@query("G12_concat", sql(["label_union"], "SELECT label_source, canonical_id, count(*) AS row_count FROM label_union GROUP BY 1, 2"))
def g12(spark, sf):
    return label_union(spark, sf).groupBy("label_source", "canonical_id").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "G13_set_difference",
    sql(["prod"], "SELECT transaction_type AS name FROM prod EXCEPT SELECT unnest(['Expense', 'Income', 'Transfer'])"),
)
def g13(spark, sf):
    kinds = adapter.production(spark, sf).select(F.col("transaction_type").alias("name"))
    allowed = spark.createDataFrame([(t,) for t in values.BATCH_TYPES], "name string")
    return kinds.subtract(allowed)


@query("G14_share_of_total", sql(["matrix"], "SELECT category_id_clean, canonical_family_clean, percentage FROM matrix"))
def g14(spark, sf):
    return cascade.category_family_matrix(pass1(spark, sf)).select(
        "category_id_clean", "canonical_family_clean", "percentage"
    )


@query("G15_hash_split", sql(["split"], "SELECT voucher_id, is_test FROM split"))
def g15(spark, sf):
    return training.hash_split(labelled(spark, sf), "voucher_id").select("voucher_id", "is_test")


@query(
    "G15_stratified_split",
    sql(
        ["train_set"],
        """SELECT normalized_desc, canonical_id, row_number() OVER (PARTITION BY canonical_id ORDER BY md5('42|' || normalized_desc), normalized_desc)
             <= round(count(*) OVER (PARTITION BY canonical_id) * 0.2) AS is_test FROM train_set""",
    ),
)
def g15_stratified(spark, sf):
    # Read once, so the categorized rows are not written for it.
    rows = training.training_set(label_union(spark, sf, cascaded(spark, sf)))
    return training.stratified_split(rows, "normalized_desc", "canonical_id").select(
        "normalized_desc", "canonical_id", "is_test"
    )


# ------------------------------------------------------------------------- proposals

_CASE = oracle.proposal_case("clean_description", "vch_type")


@query(
    "T1_contains_term",
    sql(
        ["labelled"],
        "SELECT voucher_id, "
        + ", ".join(
            f"{oracle.any_term('clean_description', w)} AS has_{f.lower()}" for f, w in lookups.PROPOSAL_TERMS.items()
        )
        + " FROM labelled",
    ),
)
def t1(spark, sf):
    from tallyspark.functions.text import contains_term_any

    return labelled(spark, sf).select(
        "voucher_id",
        *[
            contains_term_any(F.col("clean_description"), w).alias(f"has_{f.lower()}")
            for f, w in lookups.PROPOSAL_TERMS.items()
        ],
    )


@query("T2_propose_family", sql(["labelled"], f"SELECT voucher_id, {_CASE} AS proposed_family FROM labelled"))
def t2(spark, sf):
    return labelled(spark, sf).select(
        "voucher_id",
        taxonomy.propose_family(F.col("clean_description"), F.col("vch_type")).alias("proposed_family"),
    )


_PROPOSAL_ID = "CASE proposed_family " + " ".join(f"WHEN {quoted(f)} THEN {i}" for f, i in lookups.PROPOSAL_IDS.items()) + " END"
_SYNONYM = "coalesce(CASE description " + " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in lookups.SYNONYMS.items()) + " END, '')"


@query(
    "T3_proposal_groups",
    sql(
        ["proposals"],
        f"""SELECT description, vch_type, proposed_family, {_PROPOSAL_ID} AS proposed_canonical_id, transaction_support,
            dominant_source_category_id, distinct_source_category_ids, source_category_purity,
            'REVIEW_REQUIRED' AS review_status, FALSE AS approved, {quoted(lookups.PROPOSAL_NOTE)} AS evidence_note FROM proposals""",
    ),
)
def t3(spark, sf):
    return taxonomy.proposal_groups(labelled(spark, sf)).drop(
        "risk_level", "possible_synonym", "synonym_review_note"
    )


@query("T4_risk_tier", sql(["proposals"], "SELECT description, vch_type, proposed_family, risk_level FROM proposals"))
def t4(spark, sf):
    return taxonomy.proposal_groups(labelled(spark, sf)).select(
        "description", "vch_type", "proposed_family", "risk_level"
    )


@query(
    "T5_synonym_note",
    sql(
        ["proposals"],
        f"""SELECT description, vch_type, {_SYNONYM} AS possible_synonym,
            CASE WHEN {_SYNONYM} <> '' THEN {quoted(lookups.SYNONYM_NOTE)} ELSE '' END AS synonym_review_note FROM proposals""",
    ),
)
def t5(spark, sf):
    return taxonomy.proposal_groups(labelled(spark, sf)).select(
        "description", "vch_type", "possible_synonym", "synonym_review_note"
    )


@query(
    "T6_family_summary",
    sql(
        ["proposals"],
        """SELECT proposed_family, count(*) AS proposals, CAST(sum(transaction_support) AS BIGINT) AS total_transactions,
           CAST(sum(distinct_source_category_ids) AS BIGINT) AS distinct_source_categories, median(source_category_purity) AS median_purity,
           count(*) FILTER (WHERE risk_level = 'SAFE_CANDIDATE') AS safe_candidates,
           count(*) FILTER (WHERE risk_level = 'REVIEW_CANDIDATE') AS review_candidates,
           count(*) FILTER (WHERE risk_level = 'WEAK_CANDIDATE') AS weak_candidates FROM proposals GROUP BY 1""",
    ),
)
def t6(spark, sf):
    return taxonomy.family_summary(taxonomy.proposal_groups(labelled(spark, sf)))


# --------------------------------------------------------------------------- cascade


@query(
    "M1_approved_clean",
    sql(
        ["approved", "cleaned"],
        """SELECT a.description_clean, a.vch_type_clean, canonical_id, canonical_family, count(c.voucher_id) AS transaction_count
           FROM approved a LEFT JOIN cleaned c USING (description_clean, vch_type_clean) GROUP BY 1, 2, 3, 4""",
    ),
)
def m1(spark, sf):
    """Each usable approved mapping with the transactions it covers."""
    keys = ["description_clean", "vch_type_clean"]
    lookup = cascade.approved_lookup(lookups.approved_mappings(spark))
    counts = cascade.clean_inputs(adapter.raw(spark, sf)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (
        lookup.join(counts, keys, "left")
        .withColumn("transaction_count", F.coalesce("n", F.lit(0)))
        .select(*keys, "canonical_id", "canonical_family", "transaction_count")
    )


@query(
    "M2_approved_apply",
    sql(["pass1"], "SELECT voucher_id, approved_id AS canonical_id, canonical_family FROM pass1 WHERE mapping_method = 'APPROVED_MAPPING'"),
)
def m2(spark, sf):
    return pass1(spark, sf).filter("mapping_method = 'APPROVED_MAPPING'").select(
        "voucher_id", "canonical_id", "canonical_family"
    )


@query("M3_keyword_rule", sql(["first_pass"], "SELECT voucher_id, rule_family FROM first_pass"))
def m3(spark, sf):
    return cascade.clean_inputs(adapter.raw(spark, sf)).select("voucher_id", "rule_family")


@query("M4_strong_category_select", sql(["strong"], "SELECT category_id_clean, strong_family FROM strong"))
def m4(spark, sf):
    return cascade.strong_categories(dominant(spark, sf))


@query(
    "M5_category_apply",
    sql(["cat"], "SELECT voucher_id, canonical_id, canonical_family FROM cat WHERE mapping_method = 'CATEGORY_ID'"),
)
def m5(spark, sf):
    return categorized(spark, sf).filter("mapping_method = 'CATEGORY_ID'").select(
        "voucher_id", "canonical_id", "canonical_family"
    )


@query(
    "M7_cascade_resolve",
    sql(
        ["cat"],
        "SELECT voucher_id, description_clean, canonical_id, canonical_family, canonical_mapping_status, mapping_method FROM cat",
    ),
)
def m7(spark, sf):
    return cascaded(spark, sf).select(
        "voucher_id", "description_clean", "canonical_id", "canonical_family", "canonical_mapping_status", "mapping_method"
    )


@query(
    "M8_coverage",
    sql(
        ["cat"],
        """SELECT count(*) AS transactions, count(*) FILTER (WHERE canonical_family <> 'UNMAPPED') AS mapped,
           count(*) FILTER (WHERE canonical_family = 'UNMAPPED') AS unmapped,
           count(*) FILTER (WHERE canonical_family <> 'UNMAPPED') / CAST(count(*) AS DOUBLE) * 100.0 AS coverage_pct FROM cat""",
    ),
)
def m8(spark, sf):
    return cascade.coverage(categorized(spark, sf))


@query(
    "M8_coverage_report",
    sql(
        ["cat"],
        """SELECT 'method' AS section, mapping_method AS name, count(*) AS transaction_count,
             count(*) / CAST((SELECT count(*) FROM cat) AS DOUBLE) * 100.0 AS share_pct FROM cat GROUP BY 2
           UNION ALL SELECT 'family', canonical_family, count(*), count(*) / CAST((SELECT count(*) FROM cat) AS DOUBLE) * 100.0 FROM cat GROUP BY 2""",
    ),
)
def m8_report(spark, sf):
    return cascade.coverage_report(categorized(spark, sf))


@query("M10_category_family_matrix", sql(["matrix"], "SELECT * FROM matrix"))
def m10(spark, sf):
    return cascade.category_family_matrix(pass1(spark, sf))


@query("M11_dominant_family", sql(["dominant"], "SELECT * FROM dominant"))
def m11(spark, sf):
    return cascade.dominant_family(cascade.category_family_matrix(pass1(spark, sf)))


_TIER = """CASE WHEN dominant_percentage >= 95 THEN 'STRONG' WHEN dominant_percentage >= 80 THEN 'MODERATE'
  WHEN dominant_percentage >= 60 THEN 'WEAK' ELSE 'AMBIGUOUS' END"""


@query(
    "M12_strength_tier",
    sql(["dominant"], f"SELECT category_id_clean, dominant_canonical_family, {_TIER} AS mapping_strength FROM dominant"),
)
def m12(spark, sf):
    return dominant(spark, sf).select("category_id_clean", "dominant_canonical_family", "mapping_strength")


@query("M12_strength_counts", sql(["dominant"], f"SELECT {_TIER} AS mapping_strength, count(*) AS category_ids FROM dominant GROUP BY 1"))
def m12_counts(spark, sf):
    return cascade.counts_by(dominant(spark, sf), "mapping_strength", "category_ids")


@query(
    "M13_potential_coverage",
    sql(
        ["pass1", "dominant"],
        """SELECT dominant_canonical_family AS canonical_family, count(*) AS transaction_count,
             count(*) / CAST((SELECT count(*) FROM pass1) AS DOUBLE) * 100.0 AS pct_of_all
           FROM (SELECT *, coalesce(TRY_CAST(category_id AS DOUBLE), -1.0) AS cid FROM pass1) p
           JOIN dominant d ON d.category_id_clean = p.cid
           WHERE canonical_family = 'UNMAPPED' AND dominant_percentage >= 95 GROUP BY 1""",
    ),
)
def m13(spark, sf):
    return cascade.potential_coverage(pass1(spark, sf), dominant(spark, sf))


_CM = oracle.values_list([(d, s, c) for d, s, c, _ in lookups.CATEGORY_MAPPINGS])
_CX = oracle.values_list([(d, t, c) for d, t, c, _ in lookups.CONTEXTUAL_RULES])


@query(
    "M14_canonical_category",
    sql(
        ["labelled"],
        f"""SELECT voucher_id, coalesce(x.cid, m.cid, l.source_category_id) AS canonical_category FROM labelled l
            LEFT JOIN ({_CM}) AS m(d, s, cid) ON m.d = clean_description AND m.s = source_category_id
            LEFT JOIN ({_CX}) AS x(d, t, cid) ON x.d = clean_description AND x.t = vch_type""",
    ),
)
def m14(spark, sf):
    return cascade.canonical_category(
        labelled(spark, sf), lookups.category_mappings(spark), lookups.contextual_rules(spark)
    ).select("voucher_id", "canonical_category")


# ----------------------------------------------------------------------------- views

_STATS = f"""count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount, {MEAN.format('amount')} AS average_amount,
  CAST(min(amount) AS DOUBLE) AS minimum_amount, CAST(max(amount) AS DOUBLE) AS maximum_amount"""


def _sum(kind: str, expr: str, alias: str) -> str:
    return f"CAST(sum(CASE WHEN transaction_type = '{kind}' THEN {expr} ELSE 0 END) AS DOUBLE) AS {alias}"


@query(
    "A1_monthly_summary",
    sql(["prod"], f"SELECT transaction_year, transaction_month, transaction_type, {_STATS} FROM prod GROUP BY 1, 2, 3"),
)
def a1(spark, sf):
    return views.monthly_summary(adapter.production(spark, sf))


@query("A2_type_summary", sql(["prod"], f"SELECT transaction_type, {_STATS} FROM prod GROUP BY 1"))
def a2(spark, sf):
    return views.type_summary(adapter.production(spark, sf))


@query(
    "A3_consumer_summary",
    sql(
        ["prod"],
        f"""SELECT consumer_id, count(*) AS transaction_count, {_sum('Income', 'amount', 'total_income')},
            {_sum('Expense', 'amount', 'total_expense')}, {_sum('Transfer', 'amount', 'total_transfer')},
            {MEAN.format('amount')} AS average_transaction_amount, CAST(min(transaction_date) AS VARCHAR) AS first_transaction_date,
            CAST(max(transaction_date) AS VARCHAR) AS last_transaction_date FROM prod WHERE consumer_id IS NOT NULL GROUP BY 1""",
    ),
)
def a3(spark, sf):
    return views.consumer_summary(adapter.production(spark, sf))


@query(
    "A4_dq_summary",
    sql(
        ["prod"],
        """SELECT count(*) AS total_records, count(*) FILTER (WHERE missing_description) AS missing_descriptions,
           count(*) FILTER (WHERE missing_transaction_date) AS missing_transaction_dates,
           count(*) FILTER (WHERE negative_amount) AS negative_amounts, count(*) FILTER (WHERE zero_amount) AS zero_amounts,
           count(*) FILTER (WHERE invalid_transaction_type) AS invalid_transaction_types,
           count(*) FILTER (WHERE future_transaction_date) AS future_transaction_dates FROM prod""",
    ),
)
def a4(spark, sf):
    return views.dq_summary(adapter.production(spark, sf))


@query(
    "A5_financial_kpis",
    sql(
        ["prod"],
        f"""SELECT count(*) AS total_transactions, count(DISTINCT consumer_id) AS total_consumers, {_sum('Income', 'amount', 'total_income')},
            {_sum('Expense', 'amount', 'total_expense')}, {_sum('Transfer', 'amount', 'total_transfers')},
            {MEAN.format('amount')} AS average_transaction_amount, CAST(min(transaction_date) AS VARCHAR) AS earliest_transaction_date,
            CAST(max(transaction_date) AS VARCHAR) AS latest_transaction_date FROM prod""",
    ),
)
def a5(spark, sf):
    return views.financial_kpis(adapter.production(spark, sf))


@query("A6_txn_with_category", sql(["prod", "tc"], f"SELECT {_DETAIL} FROM prod p LEFT JOIN tc ON p.voucher_id = tc.voucher_id"))
def a6(spark, sf):
    return views.transactions_with_category(adapter.production(spark, sf), categorization(spark, sf))


@query(
    "A7_category_summary",
    sql(
        ["prod", "tc"],
        f"""SELECT coalesce(category_name, 'UNMAPPED') AS category_name, count(*) AS transaction_count,
            {_sum('Income', 'amount', 'total_income')}, {_sum('Expense', 'abs(amount)', 'total_expense')},
            {_sum('Transfer', 'abs(amount)', 'total_transfer')}, CAST(sum(abs(amount)) AS DOUBLE) AS total_amount,
            {MEAN.format('abs(amount)')} AS average_amount FROM prod LEFT JOIN tc USING (voucher_id) GROUP BY 1""",
    ),
)
def a7(spark, sf):
    return views.category_summary(adapter.production(spark, sf), categorization(spark, sf))


@query(
    "A8_category_type_summary",
    sql(
        ["prod", "tc"],
        f"""SELECT coalesce(category_name, 'UNMAPPED') AS category_name, transaction_type, count(*) AS transaction_count,
            CAST(sum(amount) AS DOUBLE) AS total_amount, {_sum('Expense', 'abs(amount)', 'total_expense')}
            FROM prod LEFT JOIN tc USING (voucher_id) GROUP BY 1, 2""",
    ),
)
def a8(spark, sf):
    return views.category_type_summary(adapter.production(spark, sf), categorization(spark, sf))


@query("A9_status_summary", sql(["tc"], "SELECT mapping_status, count(*) AS transaction_count FROM tc GROUP BY 1"))
def a9(spark, sf):
    return views.status_summary(categorization(spark, sf))


@query("A10_categorization_prepare", sql(["tc"], "SELECT * FROM tc"))
def a10(spark, sf):
    return categorization(spark, sf)
