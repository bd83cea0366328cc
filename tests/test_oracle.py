"""Every registered query against DuckDB."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__

QUERIES = __spark_entry__.queries()
ORACLE = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SMALL)


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLE])
def test_matches_sql(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None


def test_scores_are_probabilities_of_test_pairs(spark):
    scored = QUERIES["score_fixed_model"](spark, SMALL)
    pairs = QUERIES["ml_test_data"](spark, SMALL)
    keys = {(str(r.user_id), str(r.product_id)) for r in pairs.select("user_id", "product_id").collect()}
    rows = scored.collect()
    assert {(r.user_id, r.product_id) for r in rows} == keys
    assert all(0 <= r.predicted_probability <= 1 for r in rows)


def test_entry_has_the_declared_columns(spark):
    from basketflow.schemas import ML_COLUMNS

    frame = __spark_entry__.entry(spark)
    assert frame.columns == ML_COLUMNS
    assert frame.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    # Only text operators that SQL cannot express have no SQL.
    assert all(name.startswith("op") or name == "pipeline" for name in set(QUERIES) - set(ORACLE))
