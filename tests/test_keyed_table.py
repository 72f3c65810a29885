"""One keyed table for batch, incremental and stream loads."""

import pytest
from pyspark.sql import functions as F
from test_loading import GOOD, as_of, production_table, raw_rows, sample, write_lines

from tallyspark.plans import jobs
from tallyspark.sources import readers, sinks
from tallyspark.streaming import messages as stream

DDL = "k long, v string"


def stream_in(spark, tmp_path, table, name, rows):
    write_lines(tmp_path / "in", name, rows)
    loader = stream.MessageLoader(table, str(tmp_path / "dead"), order=["value"])
    loader.start(readers.read_message_files(spark, str(tmp_path / "in")), str(tmp_path / "cp"), available_now=True).awaitTermination()


def test_all_loads_share_one_table(spark, tmp_path):
    """What one load brought is skipped, or replaced, by the others."""
    table = production_table(spark, tmp_path)
    jobs.batch_load(sample(spark), table, as_of())
    before = {r.voucher_id: r for r in table.read().collect()}
    assert all(r.etl_loaded_at is not None for r in before.values())
    own = min(before)
    # The stream skips a voucher of the batch and brings a new one.
    stream_in(spark, tmp_path, table, "a.json", [{**GOOD, "voucher_id": own, "amount": 1}, {**GOOD, "voucher_id": 5000}, "{bad"])
    rows = {r.voucher_id: r for r in table.read().collect()}
    assert set(rows) == {*before, 5000} and rows[own] == before[own]
    assert rows[5000].source_id is None and rows[5000].etl_loaded_at is not None
    # The incremental load skips what the stream brought.
    extra = raw_rows(spark, [{"id": "1", "voucher_id": "5000", "vch_amount": "3"}, {"id": "2", "voucher_id": "5001", "vch_amount": "4"}])
    status = jobs.incremental_load(extra, table, as_of()).first()
    assert (status.detected, status.found, status.status) == (1, 1, "PASS")
    rows = {r.voucher_id: r for r in table.read().collect()}
    assert rows[5000].source_id is None and float(rows[5001].amount) == 4
    # A batch replaces the row of the stream, and its load time.
    jobs.batch_load(raw_rows(spark, [{"id": "9", "voucher_id": "5000", "vch_amount": "77"}]), table, as_of())
    after = {r.voucher_id: r for r in table.read().collect()}
    assert len(after) == len(rows) and float(after[5000].amount) == 77 and after[5000].source_id == 9
    assert after[5000].etl_loaded_at > rows[5000].etl_loaded_at and after[5001] == rows[5001]
    # The stream skips it again, although another batch of it has come since.
    stream_in(spark, tmp_path, table, "b.json", [{**GOOD, "voucher_id": 5000}, {**GOOD, "voucher_id": 5001}, {**GOOD, "voucher_id": 5002}])
    assert {r.voucher_id: r for r in table.read().collect()}.keys() == after.keys() | {5002}


def test_first_message_of_a_batch_wins(spark, tmp_path):
    table = production_table(spark, tmp_path)
    stream_in(spark, tmp_path, table, "a.json", [{**GOOD, "voucher_id": 1, "amount": a} for a in (9, 3, 5)])
    assert [float(r.amount) for r in table.read().collect()] == [3]  # ordered by the text of the message
    stream_in(spark, tmp_path, table, "b.json", [{**GOOD, "voucher_id": 1, "amount": 1}])
    assert [float(r.amount) for r in table.read().collect()] == [3]


def test_a_load_writes_only_its_rows(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "k", DDL, buckets=4)
    table.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v")), [F.col("v")])
    table.upsert(spark.createDataFrame([(5, "b"), (5, "c"), (2000, "n"), (None, "x")], DDL), [F.col("v")])
    newest = max(p.version for p in table.parts())
    assert sum(p.rows for p in table.parts() if p.version == newest) == 2
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == 1001 and rows[5] == "c" and rows[6] == "a" and rows[2000] == "n"


def test_fresh_keys_look_at_no_history(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "k", DDL, buckets=4)
    row = lambda low, high: spark.range(low, high).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    for low in (0, 1000, 2000):
        table.insert_ignore(row(low, low + 1000), [F.col("v")])
    staged = lambda df: df.withColumn("_bucket", table.bucket())
    assert table.known(staged(row(3000, 3100)))[1] == 0
    known, looked_at = table.known(staged(row(1990, 2010)))
    assert known.count() == 20 and looked_at <= 2000
    known, looked_at = table.known(staged(row(500, 501)))
    assert known.count() == 1 and looked_at <= 300
    plan = known._jdf.queryExecution().toString()
    assert "v#" not in plan.split("FileScan parquet")[1].split("]")[0]


def test_compaction_keeps_the_rows(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "k", DDL, buckets=3)
    want = {}
    for n in range(5):
        rows = [(k, f"{n}") for k in range(n * 7, n * 7 + 20)]
        load = table.upsert if n % 2 else table.insert_ignore
        load(spark.createDataFrame(rows, DDL), [F.col("v")])
        want = {**want, **dict(rows)} if n % 2 else {**dict(rows), **want}
    read = lambda: sorted((r.k, r.v) for r in table.read().collect())
    assert read() == sorted(want.items())
    assert table.compact(grown=99) == []
    assert table.compact(grown=2, file_rows=5) == [0, 1, 2]
    assert {p.kind for p in table.parts()} == {"base"} and len(table.parts()) == 3
    assert read() == sorted(want.items())
    files = spark.read.parquet(f"{tmp_path}/t/data/{table.parts()[0].folder}").inputFiles()
    assert len(files) > 3  # a heavy bucket is several files
    table.upsert(spark.createDataFrame([(0, "z")], DDL), [F.col("v")])
    assert read() == sorted({**want, 0: "z"}.items())


def test_a_load_that_dies_changes_nothing(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "k", DDL, buckets=2)
    table.upsert(spark.createDataFrame([(1, "a"), (2, "b")], DDL), [F.col("v")])
    broken = spark.createDataFrame([(1, "c"), (3, "d")], DDL).withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        table.upsert(broken, [F.col("k")])
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b")]
    table.upsert(spark.createDataFrame([(2, "e")], DDL), [F.col("v")])
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "e")]


def test_a_snapshot_that_fails_leaves_the_old_one(spark, tmp_path):
    good = spark.createDataFrame([(1, "a")], DDL)
    table = sinks.SnapshotTable(spark, str(tmp_path / "s"), good.schema)
    assert table.read().count() == 0
    table.replace(good)
    held = table.read()
    broken = spark.createDataFrame([(2, "b"), (3, "c")], DDL).withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        table.replace(broken)
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")]
    status = sinks.replace_snapshot(spark.createDataFrame([(4, "d"), (5, "e")], DDL), str(tmp_path / "s"), good).first()
    assert (status.source_count, status.target_count, status.status) == (1, 2, "REVIEW")
    # A reader that began before the replacement still has its rows.
    assert [tuple(r) for r in held.collect()] == [(1, "a")]
    assert table.read().count() == 2


def test_stream_state_is_bounded_by_its_span(spark, tmp_path):
    """The state groups by arrival time, so old keys leave it; the table still knows them."""
    write_lines(tmp_path / "in", "a.json", [GOOD])
    table = production_table(spark, tmp_path)
    loader = stream.MessageLoader(table, str(tmp_path / "dead"), order=["value"], span="10 minutes")
    first = loader.first_messages(readers.read_message_files(spark, str(tmp_path / "in")))
    plan = first._jdf.queryExecution().analyzed().toString()
    assert first.isStreaming and "EventTimeWatermark" in plan and "window" in plan
