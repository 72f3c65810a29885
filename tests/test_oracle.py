"""Registered queries against their SQL; TALLY_ALL=1 runs every one."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

QUICK = [
    "src_csv", "snk_upsert", "chk_key_unique", "P1_to_number", "P4_production_projection",
    "P8_normalize_evidence_documents", "J9_term_containment", "G8_drop_duplicates", "T3_proposal_groups",
    "M7_cascade_resolve", "M10_category_family_matrix", "A1_monthly_summary", "A3_consumer_summary",
    "A7_category_summary", "Q1_validate_table", "I2_transform_new", "K4_idempotent_insert", "E1_historical_fit",
    "E4_knn_vote", "E5_embedding_knn_vote", "E12_evaluate_decisions", "L3_training_set", "L4_text_classifier", "L6_threshold_grid", "M6_ml_apply",
]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ALL = sorted(entry_points.oracle_sql())
NAMES = ALL if os.environ.get("TALLY_ALL") else QUICK


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ALL) <= set(entry_points.queries())


def plain(value):
    return repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry_points.queries()[name](spark, sf_dir)
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry_points.entry(spark).count() >= 5
