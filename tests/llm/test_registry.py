import re

import __spark_entry__ as entry
from foldmark.llm import registry


def test_one_query_for_each_operator():
    names = [re.match(r"op(\d+)_", n)[1] for n in registry.QUERIES]
    assert sorted(map(int, names)) == list(range(1, 14))
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(registry.ORACLE_SQL) <= set(entry.oracle_sql())


def test_native_operators_run_no_python(spark):
    from foldmark.llm.fingerprints import op9_fingerprints
    from foldmark.llm.mixing import op4_mixing

    for query in (op4_mixing, op9_fingerprints):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_scans_read_ids_and_texts_only(spark):
    for name in ("op10_pii", "op5_decontamination"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
