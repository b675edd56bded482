"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest
from check_sql import TABLES, compare
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries

LIGHT = [
    "s1_parquet_scan", "s3_csv_sink", "p5_key_set_filter", "p12_split_predicates", "p13_row_validation",
    "w3_session_number", "w4_shifted_boundary", "w7_trailing_windows", "w10_percent_rank",
    "e1_time_sessions", "e2_intent_sessions", "e3_split_dates", "e4_temporal_split", "a2_session_stats",
    "a12_catalog_stats", "a18_score_percentiles", "j10_category_history_join", "x1_training_examples",
    "x_all_features", "l3_features_per_split", "d1_unique_categories", "d7_abandoned_cart_price",
    "d8_category_percentile", "d12_item_time_to_purchase", "d18_label_bought_30d", "d19_leakage_check",
    "m9_average_precision", "m11_precision_at_k", "m15_threshold_table", "m19_segment_precision",
    "k5_result_rows", "t1_stream_scoring", "t2_stream_sessions", "t2_live_session_so_far", "t2_live_intent_sessions",
    "j2_first_catalog_row", "j11_train_item_aggregates", "d21_distribution_drift", "l2_unchanged_stage", "l2_refreshed_days",
    "s8_replay_safe_sink",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", LIGHT)
def test_query_equals_its_sql(spark, db, name):
    got = queries()[name](spark, SMALL).toArrow()
    assert compare(got, db.sql(oracle_sql()[name]).to_arrow_table()) == "ok"


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).count() > 0
