"""The driver's contract: every query has SQL, and a sample of them agrees with it."""

import duckdb
import pytest

import __spark_entry__ as contract
from compare import compare, database
from traceframe import checks
from tests.conftest import SF_DIR

NAMES = [
    "kernel_logger_default_groups", "header_struct", "pid_deny_table_shuffled", "descriptor_list",
    "decode_signs_maps_and_cut_payloads", "decode_binary_types", "decode_structs",
    "extended_items_of_all_kinds", "mode_only_raw_on_error", "validation_report", "live_pid_rules",
]


def test_every_query_has_sql():
    assert set(checks.QUERIES) == set(checks.SQL)
    assert set(checks.QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1000 and "payload" in df.columns


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, db, name):
    assert compare(spark, db, name, SF_DIR).startswith("OK")


def test_lost_numbers_of_ids_with_a_wide_gap_agree_with_sql(spark, tmp_path):
    """No record of any session's second bucket comes."""
    db, path = duckdb.connect(), f"{tmp_path}/events.parquet"
    db.execute(f"""COPY (
      SELECT range + 200000 * (range // 200) AS event_id, TIMESTAMP '2024-01-01' + to_seconds(range) AS ts, range % 7 AS user_id,
        'view' AS event_type, 1.5::DOUBLE AS value, '{{"k": 1}}' AS props FROM range(400)) TO '{path}' (FORMAT parquet)""")
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    assert compare(spark, db, "lost_event_numbers", str(tmp_path)).startswith("OK")
