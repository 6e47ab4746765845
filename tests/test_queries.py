"""Every registered query against its SQL counterpart in DuckDB, and the batch run."""

import pathlib

import duckdb
import pytest

import __spark_entry__
from shelfsight import config
from shelfsight.plans import batch
from shelfsight.sources import files
from shelfsight.sources.adapters import TRANSACTION_ORDER, Tables

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).is_dir(), reason="no test data")
QUERIES = __spark_entry__.queries()
ORACLES = __spark_entry__.oracle_sql()
# Minutes of iterations for a look at row counts; test_model_and_budget covers them on small data.
ITERATIVE = {"m3_peer_clusters", "m5_quantile_regression"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _sorted(rows, order):
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple("" if v is None else str(v) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    got = _sorted(df.collect(), [df.columns.index(c) for c in columns])
    assert got == _sorted(want.fetchall(), [want.columns.index(c) for c in columns])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - ITERATIVE))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_every_counterpart_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "hist_total_p90" in df.columns


def test_batch_run(spark, tmp_path):
    t, layout = Tables(spark, DATA), batch.Layout(str(tmp_path))
    raw = {
        "transactions": t.transactions_raw.drop(*TRANSACTION_ORDER).withColumnsRenamed(
            {"outlet_id": "Outlet_ID", "volume_liters": "Volume Liters", "sku_id": "Product-ID"}
        ),
        "outlets": t.outlets_raw.drop("src_key", "src_copy"),
        "coordinates": t.coordinates_raw.drop("src_key", "src_copy"),
        "seasonality": t.seasonality_raw.drop("src_copy"),
    }
    for name, df in raw.items():
        files.write_csv(df, layout.raw(config.SOURCE_FILES[name]))
    t.poi.write.parquet(layout.poi_table)
    rules = config.ModelRules(clusters=3, cluster_tries=1)
    out = batch.run_all(spark, str(tmp_path), model_rules=rules, budget_rules=config.BudgetRules(total=100_000.0))

    status = {r.dataset: (r.status, r.rows) for r in out["manifest"].collect()}
    assert status["holidays"] == ("MISSING", None)
    assert status["transactions"] == ("OK", t.transactions.count())
    checks = {(r.dataset, r.step): r for r in out["checks"].collect()}
    for (dataset, step), r in checks.items():
        assert r.rows_before == r.rows_rejected + r.rows_after
        if step:
            assert r.rows_before == checks[(dataset, step - 1)].rows_after
    passing = batch.passing(spark, layout, "transactions").count()
    rejected = files.read_quarantine(spark, layout.quarantine).where("_dataset = 'transactions'").count()
    assert passing + rejected == status["transactions"][1]
    assert out["estimates"].where("mult_potential < hist_total_max").count() == 0
    budget = out["budget"].first()
    assert 0 < budget.allocated_lkr <= 100_000.0
    written = spark.read.option("header", True).csv(layout.prediction("team_predictions"))
    assert written.columns == ["Outlet_ID", "Maximum_Monthly_Liters"] and written.count() == out["estimates"].count()
