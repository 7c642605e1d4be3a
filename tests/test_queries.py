"""Every registered query runs on the smallest driver tables; where it has oracle SQL, DuckDB
gives the same rows."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

LLM = {n for n in E.queries() if n == "pipeline" or n[:3] in {f"op{i}" for i in range(10)}}


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["species", "days_detected", "scientific_name"]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - LLM))
def test_query(spark, sf, name):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if not sql:
        return
    import json
    from camstat import plans
    from camstat.plans.registry import output_kinds
    with open(plans.KINDS_FILE) as fh:
        kinds = json.load(fh)
    assert kinds.get(name) == output_kinds(df), "oracle_kinds.json is stale: run tools/gen_oracle_kinds.py"
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, rows)[1] == digest(cols, cur.fetchall())[1]
