import duckdb
import pytest

import __spark_entry__ as E
from lodestar.plans import layouts
from lodestar.sources.tables import TABLES

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["rule", "lhs", "rhs", "n", "confidence"]
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


FAST = ["word_count", "first_letter_count", "distinct_count_per_key", "pair_rules",
        "triple_rules", "friends_symmetric", "friends_list_order", "pagerank_edge",
        "kmeans_assign_l2", "svm_cost_gradient", "cf_user_user", "cf_item_item",
        "cms_estimate", "cms_error", "positional_join", "order_pair_support", "pagerank_packed",
        "hits_packed", *layouts.QUERIES]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    df = E.queries()[name](spark, SMOKE)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    idx = [cols.index(c) for c in sorted(cols)]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
