import json

import pytest
from pyspark.sql import functions as F

from tallyspark import lookups, schemas
from tallyspark.operators import clean, gates, incremental, quality
from tallyspark.plans import jobs
from tallyspark.sources import readers, sinks
from tallyspark.streaming import messages as stream

AS_OF = F.lit


def raw_rows(spark, rows):
    base = {c: None for c in schemas.RAW_COLUMNS}
    return spark.createDataFrame([tuple({**base, **r}[c] for c in schemas.RAW_COLUMNS) for r in rows], schemas.RAW)


def as_of():
    return F.lit("2026-01-01").cast("date")


def sample(spark, amount="10.00"):
    return raw_rows(
        spark,
        [
            {"id": str(i), "voucher_id": str(100 + i), "vch_type": "Expense", "vch_amount": amount,
             "vch_date": "2024-03-04", "vch_year": "2024", "vch_month": "3", "vch_day": "4", "vch_desc": f" d{i} "}
            for i in range(6)
        ],
    )


def test_required_columns(spark):
    df = spark.range(1).withColumnRenamed("id", "voucher_id")
    assert gates.missing_columns(df, ["voucher_id", "x", "y"]) == ["x", "y"]
    with pytest.raises(gates.GateError, match="x, y"):
        gates.require_columns(df, ["voucher_id", "x", "y"])


def test_key_gate(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (2,)], "k long")
    row = gates.key_counts(df, "k").first()
    assert (row.duplicate_keys, row.null_keys) == (3, 2)
    with pytest.raises(gates.GateError):
        gates.require_unique_key(df, "k")


def test_family_gate(spark):
    df = spark.createDataFrame([("Fuel",), ("UNMAPPED",), ("Pets",)], "canonical_family string")
    with pytest.raises(gates.GateError, match="Pets"):
        gates.require_families(df)


def test_batch_load_is_idempotent_and_logs(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "voucher_id", schemas.PRODUCTION_DDL, buckets=4)
    log = str(tmp_path / "log")
    status = jobs.batch_load(sample(spark), table, as_of(), log).first()
    assert (status.status, status.source_count, status.target_count) == ("PASS", 6, 6)
    assert not sinks.path_exists(spark, log)  # a missing log is skipped
    jobs.validate(table.read(), as_of(), log)
    jobs.batch_load(sample(spark, "20.00"), table, as_of(), log)
    rows = table.read().collect()
    assert len(rows) == 6 and {float(r.amount) for r in rows} == {20.0}
    assert {r.description for r in rows} == {f"d{i}" for i in range(6)}
    assert sinks.read_log(spark, log).count() == 2


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    ddl = "k long, v string"
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "k", ddl, buckets=8)
    table.upsert(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v")), [F.col("v")])
    before = table.versions()
    table.upsert(spark.createDataFrame([(5, "b"), (5, "c")], ddl), [F.col("v")])
    after = table.versions()
    assert sum(before[b] != after[b] for b in before) == 1
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == 100 and rows[5] == "c" and rows[6] == "a"


def test_insert_ignore_keeps_first(spark, tmp_path):
    ddl = "k long, v string"
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "k", ddl, buckets=2)
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z")], ddl)
    table.insert_ignore(batch, [F.col("v")])
    table.insert_ignore(spark.createDataFrame([(1, "0"), (2, "x")], ddl), [F.col("v")])
    assert {(r.k, r.v) for r in table.read().collect()} == {(1, "a"), (2, "x")}


def test_incremental_load(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "voucher_id", schemas.PRODUCTION_DDL, buckets=2)
    jobs.batch_load(sample(spark), table, as_of())
    extra = raw_rows(
        spark,
        [
            {"id": "99", "voucher_id": "999", "vch_type": "Transfer", "vch_amount": "2200", "vch_date": "2026-09-03",
             "vch_desc": "incremental test restaurant payment"},
            {"id": "98", "voucher_id": "100", "vch_amount": "1"},
            {"id": "97", "voucher_id": None},
        ],
    )
    row = jobs.incremental_load(extra, table, as_of()).first()
    assert (row.detected, row.found, row.target_count, row.status) == (1, 1, 7, "PASS")
    new = table.read().filter("voucher_id = 999").first()
    assert new.invalid_transaction_type and new.future_transaction_date
    assert incremental.keyless(extra).count() == 1
    again = jobs.incremental_load(extra, table, as_of()).first()
    assert (again.detected, again.target_count, again.status) == (0, 7, "PASS")


def test_validator_uses_sql_nulls(spark):
    df = clean.to_production(
        raw_rows(spark, [{"id": "1", "voucher_id": "1"}, {"id": "2", "voucher_id": "2", "vch_type": "Refund"}]), as_of()
    )
    checks = {r.check_name: r.failed for r in quality.validate_table(df, as_of()).collect()}
    assert checks["invalid_transaction_types"] == 1  # NULL is not counted here
    assert df.filter("invalid_transaction_type").count() == 2  # but it is flagged
    status = quality.overall_status(quality.validate_table(df, as_of())).first()
    assert status.check_status == "REVIEW" and status.records_checked == 2


def test_dimension_seed(spark):
    old = spark.createDataFrame([(2001, "x", "y"), (1, "keep", "")], "canonical_id int, category_name string, description string")
    got = sinks.upserted(old, lookups.category_seed(spark), "canonical_id", [F.col("category_name")])
    rows = {r.canonical_id: r.category_name for r in got.collect()}
    assert len(rows) == 10 and rows[2001] == "Dining" and rows[1] == "keep"


def test_optional_column(spark):
    df = spark.createDataFrame([("a",)], "b string")
    assert readers.first_existing(df.columns, ["x", "b"]) == "b"
    assert df.select(readers.optional_column(df, ["x"]).alias("v")).first().v is None
    assert readers.object_url("bucket", "/k.csv") == "s3a://bucket/k.csv"


GOOD = {"voucher_id": 1, "consumer_id": 2, "transaction_type": "Expense", "amount": 12.5,
        "transaction_date": "2026-9-3", "description": "x"}
CASES = [
    (GOOD, None),
    ({**GOOD, "voucher_id": None}, "missing voucher_id"),
    ({**GOOD, "transaction_type": "Transfer"}, "invalid transaction_type"),
    ({**GOOD, "amount": None}, "missing amount"),
    ({**GOOD, "transaction_date": "2026-13-03"}, "invalid transaction_date"),
    ({**GOOD, "transaction_date": ""}, None),
    ({**GOOD, "transaction_date": None}, None),
    ({**GOOD, "amount": "abc"}, "invalid amount"),
]


@pytest.mark.parametrize("message,reason", CASES)
def test_message_validation(spark, message, reason):
    df = spark.createDataFrame([(json.dumps(message),)], "value string")
    assert stream.validate(stream.decode(df)).first().reject_reason == reason


def test_bad_json(spark):
    df = spark.createDataFrame([("{oops",), ("",)], "value string")
    assert {r.reject_reason for r in stream.validate(stream.decode(df)).collect()} == {"invalid JSON"}


def production_table(spark, tmp_path, buckets=2):
    return sinks.KeyedTable(spark, str(tmp_path / "table"), "voucher_id", schemas.TABLE_DDL, buckets, schemas.LOADED_AT)


def write_lines(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_stream_equals_batch_replay(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.json", [GOOD, {**GOOD, "voucher_id": 2}, "{bad", {**GOOD, "amount": 99}])
    loader = stream.MessageLoader(production_table(spark, tmp_path), str(tmp_path / "dead"), order=["value"])

    def run():
        loader.start(
            readers.read_message_files(spark, str(source)), str(tmp_path / "cp"), available_now=True
        ).awaitTermination()

    run()
    assert loader.read().count() == 2
    write_lines(source, "b.json", [{**GOOD, "amount": 1}, {**GOOD, "voucher_id": 3}])
    run()
    rows = {r.voucher_id: float(r.amount) for r in loader.read().collect()}
    assert rows == {1: 12.5, 2: 12.5, 3: 12.5}
    assert loader.read_dead_letters(spark).count() == 1
    # a batch delivered again after a failure changes nothing
    batch = stream.accepted(stream.validate(stream.decode(spark.read.text(str(source / "b.json")).withColumn("seq", F.lit(1)))))
    stream.MessageLoader(loader.table, str(tmp_path / "dead"), order=["seq"])(batch, 1)
    assert {r.voucher_id for r in loader.read().collect()} == {1, 2, 3}


def test_quoted_line_breaks_survive(spark, tmp_path):
    rows = [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    df = spark.createDataFrame(rows, "id string, vch_desc string")
    sinks.write_table(df, str(tmp_path / "t"), fmt="csv")
    got = readers.read_csv(spark, str(tmp_path / "t"), "id string, vch_desc string").collect()
    assert sorted(tuple(r) for r in got) == rows


def test_the_loader_asks_for_an_order(tmp_path):
    with pytest.raises(ValueError):
        stream.MessageLoader(None, str(tmp_path / "dead"), order=[])
