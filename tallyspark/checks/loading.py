"""Sources, sinks, gates, projections, data-quality jobs, incremental and stream loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark import lookups, schemas
from tallyspark.checks import adapter, oracle
from tallyspark.checks.oracle import in_list, sql, strip
from tallyspark.checks.registry import query
from tallyspark.functions import text, values
from tallyspark.operators import clean, gates, incremental, quality
from tallyspark.plans import jobs
from tallyspark.session import scratch_path
from tallyspark.sources import readers, sinks
from tallyspark.streaming import messages as stream

RAW_LIST = ", ".join(schemas.RAW_COLUMNS)
PROD_TEXT = """voucher_id, source_id, consumer_id, transaction_type, CAST(amount AS DOUBLE) AS amount,
  CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_year, transaction_month, transaction_day,
  CAST(created_on AS VARCHAR) AS created_on, description, CAST(foreign_currency_amount AS DOUBLE) AS foreign_currency_amount,
  CAST(foreign_currency_rate AS DOUBLE) AS foreign_currency_rate, account_id,
  CAST(record_created_on AS VARCHAR) AS record_created_on, CAST(original_category_id AS DOUBLE) AS original_category_id,
  use_case_title, missing_description, missing_transaction_date, negative_amount, zero_amount,
  invalid_transaction_type, future_transaction_date"""
CUT = f"DATE '{adapter.LOADED_BEFORE}'"
CHANGED_FROM = "1998-06-01"


# ------------------------------------------------------------------ sources and sinks


@query(
    "src_csv",
    sql(["raw"], f"SELECT {RAW_LIST.replace('use_case_title', '')} nullif(use_case_title, '') AS use_case_title FROM raw"),
)
def src_csv(spark, sf):
    """A blank field of a delimited file is a missing value."""
    path = scratch_path(spark, "raw-csv")
    sinks.write_table(adapter.raw(spark, sf).select(*schemas.RAW_COLUMNS), path, fmt="csv")
    return readers.read_csv(spark, path)


@query(
    "src_object_store",
    sql(["raw"], "SELECT vch_type, count(*) AS transaction_count, count(vch_desc) AS described FROM raw GROUP BY 1"),
)
def src_object_store(spark, sf):
    path = scratch_path(spark, "raw-object")
    sinks.write_table(adapter.raw(spark, sf).select(*schemas.RAW_COLUMNS), path, fmt="csv")
    scheme, _, rest = path.rpartition("://")
    bucket, _, key = rest.lstrip("/").partition("/")
    df = readers.read_object(spark, bucket, key, scheme or "file")
    return df.groupBy("vch_type").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.count("vch_desc").alias("described")
    )


@query("snk_processed", sql(["prod"], f"SELECT {PROD_TEXT} FROM prod"))
def snk_processed(spark, sf):
    path = scratch_path(spark, "processed")
    sinks.write_table(adapter.production(spark, sf), path)
    return spark.read.schema(schemas.PRODUCTION_DDL).parquet(path)


@query(
    "snk_upsert",
    sql(
        ["prod", "loaded"],
        f"""SELECT voucher_id, CAST(amount * 3 AS DOUBLE) AS amount, transaction_type, 'changed' AS description
            FROM prod WHERE transaction_date >= DATE '{CHANGED_FROM}'
            UNION ALL SELECT voucher_id, CAST(amount AS DOUBLE), transaction_type, description
            FROM loaded WHERE transaction_date < DATE '{CHANGED_FROM}'""",
    ),
)
def snk_upsert(spark, sf):
    """Every changed row arrives twice; the later one must win."""
    columns = ["voucher_id", "amount", "transaction_type", "description"]
    ddl = "voucher_id long, amount decimal(18,2), transaction_type string, description string"
    table = sinks.KeyedTable(spark, scratch_path(spark, "upsert"), "voucher_id", ddl, buckets=8)
    table.insert_ignore(adapter.loaded(spark, sf).select(*columns), [F.col("amount")])
    changed = adapter.production(spark, sf).filter(F.col("transaction_date") >= CHANGED_FROM)
    twice = changed.select(
        "voucher_id",
        "transaction_type",
        F.lit("changed").alias("description"),
        "amount",
        F.explode(F.array(F.lit(2), F.lit(3))).alias("arrival"),
    ).withColumn("amount", (F.col("amount") * F.col("arrival")).cast("decimal(18,2)"))
    table.upsert(twice, [F.col("arrival")])
    return table.read()


@query(
    "snk_insert_ignore",
    sql(
        ["prod", "loaded"],
        f"""SELECT voucher_id, CAST(amount AS DOUBLE) AS amount, transaction_type, description FROM loaded
            UNION ALL SELECT voucher_id, CAST(amount * 2 AS DOUBLE), transaction_type, 'new'
            FROM prod WHERE transaction_date IS NULL OR transaction_date >= {CUT}""",
    ),
)
def snk_insert_ignore(spark, sf):
    """All rows arrive again, twice; only unseen keys enter, with their first arrival."""
    columns = ["voucher_id", "amount", "transaction_type", "description"]
    ddl = "voucher_id long, amount decimal(18,2), transaction_type string, description string"
    table = sinks.KeyedTable(spark, scratch_path(spark, "insert"), "voucher_id", ddl, buckets=8)
    table.insert_ignore(adapter.loaded(spark, sf).select(*columns), [F.col("amount")])
    again = adapter.production(spark, sf).select(
        "voucher_id",
        "transaction_type",
        F.lit("new").alias("description"),
        "amount",
        F.explode(F.array(F.lit(2), F.lit(3))).alias("arrival"),
    ).withColumn("amount", (F.col("amount") * F.col("arrival")).cast("decimal(18,2)"))
    table.insert_ignore(again, [F.col("arrival")])
    return table.read()


@query(
    "snk_snapshot",
    sql(
        ["tc", "prod"],
        """SELECT (SELECT count(*) FROM prod) AS source_count, count(*) AS target_count,
           (SELECT count(*) FROM prod) - count(*) AS difference,
           CASE WHEN count(*) = (SELECT count(*) FROM prod) THEN 'PASS' ELSE 'REVIEW' END AS status FROM tc""",
    ),
)
def snk_snapshot(spark, sf):
    from tallyspark.checks.mapping import categorization

    return sinks.replace_snapshot(
        categorization(spark, sf), scratch_path(spark, "snapshot"), adapter.production(spark, sf)
    )


@query(
    "snk_dim_seed",
    sql(
        ["cat"],
        f"""WITH seed AS (SELECT * FROM ({oracle.values_list(lookups.CATEGORY_SEED)}) AS t(canonical_id, category_name, description))
            SELECT * FROM seed UNION ALL
            SELECT DISTINCT canonical_id, canonical_family, 'observed' FROM cat
            WHERE canonical_id IS NOT NULL AND canonical_id NOT IN (SELECT canonical_id FROM seed)""",
    ).replace(")\nWITH seed AS", "),\nseed AS"),
)
def snk_dim_seed(spark, sf):
    from tallyspark.checks.mapping import categorized

    observed = (
        categorized(spark, sf)
        .filter("canonical_id is not null")
        .select("canonical_id", F.col("canonical_family").alias("category_name"), F.lit("observed").alias("description"))
        .distinct()
    )
    return sinks.upserted(
        observed, lookups.category_seed(spark), "canonical_id", [F.col("category_name")]
    )


_STATUS_SQL = f"""
  SELECT CASE WHEN failed = 0 THEN 'PASS' ELSE 'REVIEW' END AS check_status, total AS records_checked, failed AS records_failed
  FROM (SELECT count(*) AS total,
    (SELECT count(*) FROM (SELECT voucher_id FROM prod GROUP BY 1 HAVING count(*) > 1))
    + count(*) FILTER (WHERE voucher_id IS NULL)
    + count(*) FILTER (WHERE transaction_type NOT IN ('Expense', 'Income', 'Transfer'))
    + count(*) FILTER (WHERE trim(description) = '') + count(*) FILTER (WHERE amount IS NULL)
    + count(*) FILTER (WHERE amount < 0) + count(*) FILTER (WHERE transaction_date IS NULL)
    + count(*) FILTER (WHERE transaction_date > DATE '{adapter.AS_OF}')
    + count(*) FILTER (WHERE transaction_year <> year(transaction_date))
    + count(*) FILTER (WHERE transaction_month <> month(transaction_date))
    + count(*) FILTER (WHERE transaction_day <> day(transaction_date)) AS failed FROM prod)"""


@query(
    "snk_dq_log",
    sql(["prod"], f"SELECT 'DATA_QUALITY' AS check_name, 'table validation' AS details, s.* FROM ({_STATUS_SQL}) s"),
)
def snk_dq_log(spark, sf):
    path = scratch_path(spark, "dq-log")
    status = quality.overall_status(quality.validate_table(adapter.production(spark, sf), adapter.as_of()))
    row = sinks.log_row(
        "DATA_QUALITY",
        F.col("check_status"),
        F.col("records_checked"),
        F.col("records_failed"),
        "table validation",
        F.lit("2026-01-01 00:00:00"),
    )
    sinks.append_log(status.select(*row), path)
    return sinks.read_log(spark, path).drop("check_timestamp")


@query(
    "snk_reports",
    sql(["prod"], "SELECT transaction_type, CAST(count(*) AS VARCHAR) AS transaction_count FROM prod GROUP BY 1"),
)
def snk_reports(spark, sf):
    path = scratch_path(spark, "report")
    sinks.write_report(quality.type_distribution(adapter.production(spark, sf)), path)
    return readers.read_csv(spark, path, "transaction_type string, transaction_count string")


# --------------------------------------------------------------------------- gates


@query(
    "chk_required_cols",
    sql(
        ["raw"],
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, TRUE AS present, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM raw"
            for c in schemas.RAW_COLUMNS
        )
        + " UNION ALL SELECT 'source_category_id', FALSE, CAST(NULL AS BIGINT)",
    ),
)
def chk_required_cols(spark, sf):
    return gates.column_report(adapter.raw(spark, sf), [*schemas.RAW_COLUMNS, "source_category_id"])


@query(
    "resolve_optional_col",
    sql(["raw"], "SELECT voucher_id, vch_desc AS description, CAST(NULL AS VARCHAR) AS matched_term FROM raw"),
)
def resolve_optional_col(spark, sf):
    df = adapter.raw(spark, sf)
    return df.select(
        "voucher_id",
        readers.optional_column(df, ["transaction_text", "vch_desc", "description"]).alias("description"),
        readers.optional_column(df, ["canonical_matched_term", "matched_term"]).alias("matched_term"),
    )


@query(
    "chk_key_unique",
    """SELECT CAST(count(*) - count(DISTINCT l_orderkey) - count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS duplicate_keys,
       count(*) FILTER (WHERE l_orderkey IS NULL) AS null_keys FROM lineitem""",
)
def chk_key_unique(spark, sf):
    return gates.key_counts(adapter.table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "chk_type_domain",
    sql(["prod"], "SELECT DISTINCT transaction_type FROM prod WHERE transaction_type NOT IN ('Expense', 'Income', 'Transfer')"),
)
def chk_type_domain(spark, sf):
    return gates.values_outside(adapter.production(spark, sf), "transaction_type", values.BATCH_TYPES)


@query(
    "chk_family_domain",
    sql(
        ["cat"],
        f"SELECT DISTINCT canonical_family FROM cat WHERE canonical_family NOT IN {in_list([*lookups.TAXONOMY_V1.values(), 'UNMAPPED'])}",
    ),
)
def chk_family_domain(spark, sf):
    """Against the older taxonomy, so that there is something to find."""
    from tallyspark.checks.mapping import categorized

    return gates.families_outside(categorized(spark, sf), "v1")


# --------------------------------------------------------------------- projections


@query(
    "P1_to_number",
    sql(
        ["raw"],
        """SELECT voucher_id AS key, TRY_CAST(voucher_id AS BIGINT) AS voucher_id, TRY_CAST(consumer_id AS BIGINT) AS consumer_id,
           CAST(TRY_CAST(vch_amount AS DECIMAL(18,2)) AS DOUBLE) AS vch_amount, TRY_CAST(vch_year AS INT) AS vch_year,
           CAST(TRY_CAST(fc_rate AS DECIMAL(18,6)) AS DOUBLE) AS fc_rate, TRY_CAST(id AS BIGINT) AS id,
           TRY_CAST(account_id AS BIGINT) AS account_id, TRY_CAST(vch_month AS INT) AS vch_month, TRY_CAST(vch_day AS INT) AS vch_day,
           CAST(TRY_CAST(fc_amount AS DECIMAL(18,2)) AS DOUBLE) AS fc_amount,
           TRY_CAST(category_id AS DOUBLE) AS category_id FROM raw""",
    ),
)
def p1(spark, sf):
    """All eleven numeric columns."""
    df = clean.numbers(adapter.raw(spark, sf).withColumn("key", F.col("voucher_id")))
    return df.select("key", *clean.TYPES, "vch_amount", "fc_amount", "fc_rate", "category_id")


@query(
    "P2_to_datetime",
    sql(
        ["raw"],
        f"""SELECT voucher_id, CAST({oracle.date_of('vch_date')} AS VARCHAR) AS vch_date,
           CAST(TRY_CAST(vch_created_on AS TIMESTAMP) AS VARCHAR) AS vch_created_on,
           CAST(TRY_CAST(record_created_on AS TIMESTAMP) AS VARCHAR) AS record_created_on FROM raw""",
    ),
)
def p2(spark, sf):
    return clean.dates(adapter.raw(spark, sf)).select(
        "voucher_id", "vch_date", "vch_created_on", "record_created_on"
    )


@query(
    "P3_trim_text",
    sql(
        ["raw"],
        f"SELECT voucher_id, {strip('vch_type')} AS vch_type, {strip('vch_desc')} AS vch_desc, {strip('use_case_title')} AS use_case_title FROM raw",
    ),
)
def p3(spark, sf):
    return clean.texts(adapter.raw(spark, sf)).select("voucher_id", "vch_type", "vch_desc", "use_case_title")


@query("P4_production_projection", sql(["prod"], f"SELECT {PROD_TEXT} FROM prod"))
def p4(spark, sf):
    return adapter.production(spark, sf)


@query("P5_dq_flags", sql(["prod"], f"SELECT voucher_id, {', '.join(schemas.FLAGS)} FROM prod"))
def p5(spark, sf):
    return adapter.production(spark, sf).select("voucher_id", *schemas.FLAGS)


@query("P6_dq_flags_incremental", sql(["inc"], f"SELECT voucher_id, {', '.join(schemas.FLAGS)} FROM inc"))
def p6(spark, sf):
    return incremental.transform_new(adapter.raw(spark, sf), adapter.as_of()).select(
        "voucher_id", *schemas.FLAGS
    )


@query(
    "P7_null_edge",
    "SELECT event_id, CASE WHEN value > 10 THEN value END AS value FROM events",
)
def p7(spark, sf):
    events = adapter.table(spark, sf, "events").select("event_id", "value")
    marked = events.withColumn("value", F.when(F.col("value") > 10, F.col("value")).otherwise(float("nan")))
    return clean.null_edge(marked, ["value"])


def _document_text(name: str, normalize, oracle_expr: str) -> None:
    @query(name, f"SELECT doc_id, {oracle_expr} AS cleaned FROM documents")
    def run(spark, sf):
        documents = adapter.table(spark, sf, "documents")
        return documents.select("doc_id", normalize(F.col("text")).alias("cleaned"))


_document_text("P8_normalize_evidence_documents", text.normalize_evidence, oracle.p8("text"))
_document_text("P9_normalize_cascade_documents", text.normalize_cascade, oracle.p9("text"))


@query("P8_normalize_evidence", sql(["raw"], f"SELECT voucher_id, {oracle.p8('vch_desc')} AS cleaned FROM raw"))
def p8(spark, sf):
    return adapter.raw(spark, sf).select("voucher_id", text.normalize_evidence(F.col("vch_desc")).alias("cleaned"))


@query("P9_normalize_cascade", sql(["raw"], f"SELECT voucher_id, {oracle.p9('vch_desc')} AS cleaned FROM raw"))
def p9(spark, sf):
    return adapter.raw(spark, sf).select("voucher_id", text.normalize_cascade(F.col("vch_desc")).alias("cleaned"))


@query(
    "P10_normalize_type_category",
    sql(["raw"], f"SELECT voucher_id, {oracle.p10_type('vch_type')} AS vch_type_clean, {oracle.p10_id('category_id')} AS category_id_clean FROM raw"),
)
def p10(spark, sf):
    return adapter.raw(spark, sf).select(
        "voucher_id",
        text.normalize_type(F.col("vch_type")).alias("vch_type_clean"),
        text.normalize_category_id(F.col("category_id")).alias("category_id_clean"),
    )


@query(
    "P11_normalize_training",
    sql(["raw"], f"SELECT voucher_id, {oracle.p11('vch_desc')} AS training, coalesce({oracle.squeeze('vch_desc')}, '') AS ml FROM raw"),
)
def p11(spark, sf):
    return adapter.raw(spark, sf).select(
        "voucher_id",
        text.normalize_training(F.col("vch_desc")).alias("training"),
        text.normalize_ml(F.col("vch_desc")).alias("ml"),
    )


@query("P12_normalize_diag", sql(["raw"], f"SELECT voucher_id, {oracle.p12('vch_desc')} AS cleaned FROM raw"))
def p12(spark, sf):
    return adapter.raw(spark, sf).select("voucher_id", text.normalize_diagnostic(F.col("vch_desc")).alias("cleaned"))


_PROPOSED = oracle.proposal_case("clean_description", "vch_type")


@query(
    "P13_family_alias",
    sql(
        ["labelled"],
        f"""SELECT proposed, {oracle.alias_case('proposed', lookups.CASCADE_ALIASES)} AS cascade,
            {oracle.alias_case('proposed', lookups.TRAINING_ALIASES)} AS training,
            {oracle.alias_case('proposed', lookups.CLASSIFIER_ALIASES)} AS classifier, count(*) AS transaction_count
            FROM (SELECT {_PROPOSED} AS proposed FROM labelled) GROUP BY 1, 2, 3, 4""",
    ),
)
def p13(spark, sf):
    from tallyspark.operators.taxonomy import propose_family

    rows = clean.sane_labelled(adapter.raw(spark, sf)).select(
        propose_family(F.col("clean_description"), F.col("vch_type")).alias("proposed")
    )
    return rows.groupBy(
        "proposed",
        text.family_alias(F.col("proposed"), lookups.CASCADE_ALIASES).alias("cascade"),
        text.family_alias(F.col("proposed"), lookups.TRAINING_ALIASES).alias("training"),
        text.family_alias(F.col("proposed"), lookups.CLASSIFIER_ALIASES).alias("classifier"),
    ).agg(F.count(F.lit(1)).alias("transaction_count"))


@query(
    "P14_taxonomy_lookup",
    sql(
        ["cat"],
        f"""SELECT voucher_id, canonical_id, {oracle.family_case('canonical_id')} AS name_v2,
            {oracle.family_case('canonical_id', lookups.TAXONOMY_V1)} AS name_v1,
            {oracle.id_case('canonical_family')} AS id_of_name FROM cat""",
    ),
)
def p14(spark, sf):
    from tallyspark.checks.mapping import categorized
    from tallyspark.operators.taxonomy import family_to_id, id_to_family

    return categorized(spark, sf).select(
        "voucher_id",
        "canonical_id",
        id_to_family(F.col("canonical_id")).alias("name_v2"),
        id_to_family(F.col("canonical_id"), "v1").alias("name_v1"),
        family_to_id(F.col("canonical_family")).alias("id_of_name"),
    )


@query(
    "P15_sane_category_filter",
    sql(["labelled"], "SELECT voucher_id, source_category_id, clean_description, vch_type FROM labelled"),
)
def p15(spark, sf):
    return clean.sane_labelled(adapter.raw(spark, sf)).select(
        F.col("voucher_id").cast("long").alias("voucher_id"),
        "source_category_id",
        "clean_description",
        "vch_type",
    )


@query(
    "P16_date_parts",
    sql(
        ["prod"],
        """SELECT voucher_id, CAST(year(transaction_date) AS INT) AS date_year, CAST(month(transaction_date) AS INT) AS date_month,
           CAST(day(transaction_date) AS INT) AS date_day,
           coalesce(transaction_year = year(transaction_date), FALSE) AS year_agrees,
           coalesce(transaction_month = month(transaction_date), FALSE) AS month_agrees,
           coalesce(transaction_day = day(transaction_date), FALSE) AS day_agrees FROM prod""",
    ),
)
def p16(spark, sf):
    return clean.date_parts_agree(adapter.production(spark, sf))


@query(
    "P17_abs_case_money",
    sql(
        ["prod"],
        """SELECT voucher_id, CAST(CASE WHEN transaction_type = 'Income' THEN amount ELSE 0 END AS DOUBLE) AS income,
           CAST(CASE WHEN transaction_type = 'Expense' THEN abs(amount) ELSE 0 END AS DOUBLE) AS expense FROM prod""",
    ),
)
def p17(spark, sf):
    kind, amount = F.col("transaction_type"), F.col("amount")
    return adapter.production(spark, sf).select(
        "voucher_id",
        values.amount_of("Income", kind, amount).alias("income"),
        values.amount_of("Expense", kind, F.abs(amount)).alias("expense"),
    )


@query("P18_confidence_rounding", "SELECT event_id, round(value / 7, 4) AS rounded FROM events")
def p18(spark, sf):
    return adapter.table(spark, sf, "events").select("event_id", F.round(F.col("value") / 7, 4).alias("rounded"))


# -------------------------------------------------------------------- data quality

_CHECKS = {
    "total_records": ("count(*)", False),
    "duplicate_voucher_ids": ("(SELECT count(*) FROM (SELECT voucher_id FROM prod GROUP BY 1 HAVING count(*) > 1))", True),
    "null_voucher_ids": ("count(*) FILTER (WHERE voucher_id IS NULL)", True),
    "invalid_transaction_types": ("count(*) FILTER (WHERE transaction_type NOT IN ('Expense', 'Income', 'Transfer'))", True),
    "null_descriptions": ("count(*) FILTER (WHERE description IS NULL)", False),
    "empty_descriptions": ("count(*) FILTER (WHERE trim(description) = '')", True),
    "null_amounts": ("count(*) FILTER (WHERE amount IS NULL)", True),
    "negative_amounts": ("count(*) FILTER (WHERE amount < 0)", True),
    "zero_amounts": ("count(*) FILTER (WHERE amount = 0)", False),
    "null_transaction_dates": ("count(*) FILTER (WHERE transaction_date IS NULL)", True),
    "future_transaction_dates": (f"count(*) FILTER (WHERE transaction_date > DATE '{adapter.AS_OF}')", True),
    "invalid_years": ("count(*) FILTER (WHERE transaction_year <> year(transaction_date))", True),
    "invalid_months": ("count(*) FILTER (WHERE transaction_month <> month(transaction_date))", True),
    "invalid_days": ("count(*) FILTER (WHERE transaction_day <> day(transaction_date))", True),
    "null_categories": ("count(*) FILTER (WHERE original_category_id IS NULL)", False),
    "null_consumers": ("count(*) FILTER (WHERE consumer_id IS NULL)", False),
    "canonical_categories": ("(SELECT count(DISTINCT canonical_id) FROM cat)", False),
}


@query(
    "Q1_validate_table",
    sql(
        ["prod", "cat"],
        " UNION ALL ".join(
            f"SELECT '{n}' AS check_name, {e} AS failed, {str(c).upper()} AS critical"
            + ("" if e.startswith("(") else " FROM prod")
            for n, (e, c) in _CHECKS.items()
        ),
    ),
)
def q1(spark, sf):
    from tallyspark.checks.mapping import categorized

    categories = categorized(spark, sf).filter("canonical_id is not null").select("canonical_id").distinct()
    return quality.validate_table(adapter.production(spark, sf), adapter.as_of(), categories)


@query("Q2_overall_status", sql(["prod"], _STATUS_SQL))
def q2(spark, sf):
    return quality.overall_status(quality.validate_table(adapter.production(spark, sf), adapter.as_of()))


_PROD_NAMES = [part.split()[0] for part in schemas.PRODUCTION_DDL.split(", ")]


@query(
    "Q3_profile_table",
    sql(
        ["prod"],
        " UNION ALL ".join(
            ["SELECT 'rows' AS metric, count(*) AS value FROM prod", f"SELECT 'columns', {len(_PROD_NAMES)}"]
            + [f"SELECT 'null_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM prod" for c in _PROD_NAMES]
            + [
                f"SELECT 'blank_description', count(*) FILTER (WHERE coalesce({strip('description')}, '') = '') FROM prod",
                "SELECT 'negative_amount', count(*) FILTER (WHERE amount < 0) FROM prod",
                "SELECT 'zero_amount', count(*) FILTER (WHERE amount = 0) FROM prod",
                f"SELECT 'future_date', count(*) FILTER (WHERE transaction_date > DATE '{adapter.AS_OF}') FROM prod",
                "SELECT 'duplicate_voucher_id', count(*) - count(DISTINCT voucher_id) FROM prod",
            ]
        ),
    ),
)
def q3(spark, sf):
    return quality.profile_table(adapter.production(spark, sf), adapter.as_of())


@query(
    "Q3_value_ranges",
    sql(
        ["prod"],
        """SELECT CAST(min(amount) AS DOUBLE) AS min_amount, CAST(max(amount) AS DOUBLE) AS max_amount,
           CAST(min(transaction_date) AS VARCHAR) AS min_date, CAST(max(transaction_date) AS VARCHAR) AS max_date,
           count(*) FILTER (WHERE transaction_date IS NULL) AS invalid_dates FROM prod""",
    ),
)
def q3_ranges(spark, sf):
    return quality.value_ranges(adapter.production(spark, sf))


@query(
    "Q3_distributions",
    sql(
        ["cat"],
        """SELECT 'canonical_mapping_status' AS part, canonical_mapping_status AS first, CAST(NULL AS VARCHAR) AS second, count(*) AS row_count FROM cat GROUP BY 2
           UNION ALL SELECT 'canonical_id,canonical_family', CAST(canonical_id AS VARCHAR), canonical_family, count(*) FROM cat GROUP BY 2, 3
           UNION ALL SELECT 'category_id', category_id, NULL, count(*) FROM cat GROUP BY 2
           UNION ALL SELECT 'vch_type', vch_type, NULL, count(*) FROM cat GROUP BY 2
           UNION ALL SELECT 'missing', 'canonical_id', NULL, count(*) FILTER (WHERE canonical_id IS NULL) FROM cat
           UNION ALL SELECT 'missing', 'canonical_family', NULL, count(*) FILTER (WHERE canonical_family IS NULL) FROM cat""",
    ),
)
def q3_distributions(spark, sf):
    """Status, (id, family), category and type distributions of the categorized rows in one scan, and missing canonical values."""
    from tallyspark.checks.mapping import categorized

    rows = categorized(spark, sf)
    groups = [["canonical_mapping_status"], ["canonical_id", "canonical_family"], ["category_id"], ["vch_type"]]
    missing = quality.missing_counts(rows, ["canonical_id", "canonical_family"])
    return quality.distributions(rows, groups).unionByName(missing)


@query(
    "Q4_etl_status",
    sql(
        ["raw", "prod"],
        """SELECT (SELECT count(*) FROM raw) AS source_count, count(*) AS target_count,
           (SELECT count(*) FROM raw) - count(*) AS difference, 'PASS' AS status FROM prod""",
    ),
)
def q4(spark, sf):
    return jobs.etl_status(adapter.raw(spark, sf), adapter.production(spark, sf))


@query(
    "Q5_flag_totals",
    sql(
        ["prod"],
        "SELECT count(*) AS total_records, "
        + ", ".join(f"count(*) FILTER (WHERE {f}) AS {f}" for f in schemas.FLAGS)
        + " FROM prod",
    ),
)
def q5(spark, sf):
    return quality.flag_totals(adapter.production(spark, sf))


@query("Q6_type_distribution", sql(["prod"], "SELECT transaction_type, count(*) AS transaction_count FROM prod GROUP BY 1"))
def q6(spark, sf):
    return quality.type_distribution(adapter.production(spark, sf))


@query(
    "Q7_post_cast_invalid",
    sql(
        ["typed"],
        """SELECT count(*) FILTER (WHERE voucher_id IS NULL) AS invalid_voucher_id,
           count(*) FILTER (WHERE vch_amount IS NULL) AS invalid_vch_amount,
           count(*) FILTER (WHERE vch_date IS NULL) AS invalid_vch_date FROM typed""",
    ),
)
def q7(spark, sf):
    return quality.post_cast_invalid(adapter.typed(spark, sf))


# --------------------------------------------------------------------- incremental


@query(
    "I1_detect_new",
    sql(["raw", "loaded"], f"SELECT {RAW_LIST} FROM raw WHERE CAST(voucher_id AS BIGINT) NOT IN (SELECT voucher_id FROM loaded)"),
)
def i1(spark, sf):
    return incremental.detect_new(adapter.raw(spark, sf), adapter.loaded(spark, sf)).select(*schemas.RAW_COLUMNS)


@query(
    "I2_transform_new",
    sql(["inc", "loaded"], f"SELECT {PROD_TEXT} FROM inc WHERE voucher_id NOT IN (SELECT voucher_id FROM loaded)"),
)
def i2(spark, sf):
    return incremental.rows_to_insert(adapter.raw(spark, sf), adapter.loaded(spark, sf), adapter.as_of())


@query(
    "I3_reconcile",
    sql(
        ["prod", "loaded"],
        """SELECT (SELECT count(*) FROM prod) - (SELECT count(*) FROM loaded) AS detected,
           (SELECT count(*) FROM prod) - (SELECT count(*) FROM loaded) AS found,
           (SELECT count(*) FROM prod) AS target_count, 'PASS' AS status""",
    ),
)
def i3(spark, sf):
    source, target = adapter.raw(spark, sf), adapter.loaded(spark, sf)
    detected = incremental.detect_new(source, target)
    after = target.unionByName(incremental.rows_to_insert(source, target, adapter.as_of()))
    return incremental.reconcile(detected, after)


# -------------------------------------------------------------------------- stream

_BAD = "NOT json_valid(value)"


def _field(name: str) -> str:
    return f"json_extract_string(CASE WHEN json_valid(value) THEN value ELSE '{{}}' END, '$.{name}')"


_FIELDS = ["voucher_id", "consumer_id", "transaction_type", "amount", "transaction_date", "description"]
_DECODED = f"SELECT seq, value, {_BAD} AS bad_json, " + ", ".join(f"{_field(f)} AS {f}" for f in _FIELDS) + " FROM msg"
_VALIDATED = f"""SELECT seq, value,
    CASE WHEN bad_json THEN 'invalid JSON' WHEN voucher_id IS NULL THEN 'missing voucher_id'
      WHEN coalesce(transaction_type NOT IN ('Expense', 'Income'), TRUE) THEN 'invalid transaction_type'
      WHEN amount IS NULL THEN 'missing amount'
      WHEN transaction_date <> '' AND TRY_CAST(transaction_date AS DATE) IS NULL THEN 'invalid transaction_date' END AS reject_reason,
    TRY_CAST(voucher_id AS BIGINT) AS voucher_id, TRY_CAST(consumer_id AS BIGINT) AS consumer_id, transaction_type,
    TRY_CAST(amount AS DOUBLE) AS amount, CAST(TRY_CAST(nullif(transaction_date, '') AS DATE) AS VARCHAR) AS transaction_date, description
  FROM ({_DECODED})"""


@query("K1_decode", sql(["msg"], _DECODED))
def k1(spark, sf):
    return stream.decode(adapter.messages(spark, sf))


@query("K2_validate", sql(["msg"], f"SELECT * EXCLUDE (value) FROM ({_VALIDATED})"))
def k2(spark, sf):
    return stream.validate(stream.decode(adapter.messages(spark, sf))).drop("value", "bad_json")


@query("K3_reject_route", sql(["msg"], f"SELECT value, reject_reason FROM ({_VALIDATED}) WHERE reject_reason IS NOT NULL"))
def k3(spark, sf):
    return stream.rejected(stream.validate(stream.decode(adapter.messages(spark, sf))))


@query(
    "K4_idempotent_insert",
    sql(
        ["msg", "loaded"],
        f"""SELECT seq, voucher_id, CASE WHEN rn = 1 AND voucher_id NOT IN (SELECT voucher_id FROM loaded)
              THEN 'INSERTED' ELSE 'SKIPPED' END AS outcome
            FROM (SELECT *, row_number() OVER (PARTITION BY voucher_id ORDER BY seq) AS rn
                  FROM ({_VALIDATED}) WHERE reject_reason IS NULL)""",
    ),
)
def k4(spark, sf):
    good = stream.accepted(stream.validate(stream.decode(adapter.messages(spark, sf))))
    return stream.insert_outcome(good, adapter.loaded(spark, sf), [F.col("seq")]).select(
        "seq", "voucher_id", "outcome"
    )


@query(
    "src_stream_json",
    sql(
        ["msg"],
        f"""SELECT voucher_id, consumer_id, transaction_type, amount, transaction_date, description
            FROM (SELECT *, row_number() OVER (PARTITION BY voucher_id ORDER BY value) AS rn
                  FROM ({_VALIDATED}) WHERE reject_reason IS NULL) WHERE rn = 1""",
    ),
)
def src_stream_json(spark, sf):
    """The messages as files of JSON lines, read as a stream into the keyed loader."""
    root = scratch_path(spark, "stream")
    adapter.messages(spark, sf).select("value").write.text(f"{root}/in")
    table = sinks.KeyedTable(spark, f"{root}/table", "voucher_id", schemas.TABLE_DDL, buckets=8, loaded_at=schemas.LOADED_AT)
    loader = stream.MessageLoader(table, f"{root}/dead", order=["value"])
    loader.start(
        readers.read_message_files(spark, f"{root}/in"), f"{root}/checkpoint", available_now=True
    ).awaitTermination()
    return loader.read()
