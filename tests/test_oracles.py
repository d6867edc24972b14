"""Every registered query against its DuckDB oracle at sf0.01 (driver gate)."""

import duckdb
import pytest

from conftest import SF_CHECK, SF_SMALL
from scorewell.plans.queries import oracle_sql, queries
from scorewell.session import TABLES
from tools.check_oracles import compare


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF_CHECK)
    assert res["status"] in ("ok", "rows-only"), res


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["feature", "level", "n", "avg_label", "calibrated"]
    assert all(r["calibrated"] for r in rows)
    assert set(e.oracle_sql()) <= set(e.queries())
    assert SF_SMALL in e.SMOKE_DIR


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_reads_the_given_tables(spark, name, tmp_path):
    """With an empty data folder every query fails: none runs on fixed input alone."""
    empty = tmp_path / "no_tables"
    empty.mkdir()
    with pytest.raises(Exception):
        queries()[name](spark, str(empty)).collect()
