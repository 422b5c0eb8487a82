import glob
import os
import re

import duckdb
import pytest

from buzzmill.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(found, columns, wanted):
    return sorted([tuple(r[columns.index(c)] for c in wanted) for r in found], key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    q = duck.execute(SQL[name])
    columns = [d[0] for d in q.description]
    assert sorted(columns) == sorted(df.columns)
    wanted = sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns, wanted) == rows(q.fetchall(), columns, wanted)


def test_all_row_is_recomputed(spark):
    d = QUERIES["daily_brand_metrics"](spark, SF).toPandas()
    parts = d[d.platform_code != "all"].groupby(["metric_date", "brand_id"]).buzz_count.sum()
    whole = d[d.platform_code == "all"].set_index(["metric_date", "brand_id"]).buzz_count
    assert (parts.sort_index() == whole.sort_index()).all()


@pytest.mark.parametrize("name", ["keyword_filter_nested", "merge_comments"])
def test_long_conversations(spark, tmp_path, name):
    """One conversation with most rows, and odd turns; no list of all of its rows is built."""
    texts = ["The x", "hathe", None, "y", ""]
    data = [(1, k, texts[k % 5]) for k in range(3000)] + [(2, 0, "hathe"), (2, 1, "the"), (3, 5, "the"), (4, None, "the"), (5, 0, None), (5, -1, "the"), (5, 4, "the"), (None, 2, "the"), (None, 0, "a"), (6, 0, "the"), (6, 0, "a")]
    where = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([(*d, "user") for d in data], "conv_id long, turn int, text string, role string").write.parquet(where)
    df, c = QUERIES[name](spark, str(tmp_path)), duckdb.connect()
    c.execute(f"create view conversations as select * from '{where}/*.parquet'")
    q = c.execute(SQL[name])
    columns = [d[0] for d in q.description]
    assert rows([tuple(r) for r in df.collect()], df.columns, columns) == rows(q.fetchall(), columns, columns)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "collect_list" not in plan or re.search(r"keys?=\[conv_id#\d+L?, external_id", plan)
