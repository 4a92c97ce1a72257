import __spark_entry__ as entry
from foldmark.plans import catalogue


def test_entry_gives_cells(spark):
    out = entry.entry(spark)
    assert out.columns[:2] == ["kind", "cell"] and out.count() >= 2


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(catalogue.QUERIES) >= 60


def test_scans_read_what_they_need(spark):
    """Column pruning and filters reach the Parquet scan."""
    plan = entry.queries()["interval_regime"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    plan = entry.queries()["universe_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_size), LessThanOrEqual(p_size,25)]" in plan


def test_import_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=entry.__file__.rsplit("/", 1)[0], capture_output=True, text=True, timeout=120)
    assert found.returncode == 0 and int(found.stdout.split()[-1]) == len(entry.queries()), found.stderr
