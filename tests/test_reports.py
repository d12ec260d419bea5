"""Reports against DuckDB and against what must always hold."""

import duckdb
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry
from merchlens.params import RETAIL_PARAMS
from merchlens.plans import concentration, retention
from merchlens.registry import registered

# A spread over the modules; ``tests/oracle.py`` compares every key.
COMPARED = [
    "kpi_panel", "revenue_yoy_month", "variance_by_category", "category_value_divergence", "bottom_products_by_profit",
    "city_rpc_index", "region_yoy", "category_mix_by_channel", "frequency_tier_value", "value_deciles",
    "repeat_90d_rate", "value_leakage_ranked", "rfm_segments", "cohort_retention", "clv_percentiles", "topn_ladder",
    "lorenz_curve", "gini", "non_explanatory_variables", "portfolio_by_framework", "discount_allocation",
    "customer_monthly_snapshot", "dq_cross_table_rule", "dq_explained_negatives", "verdicts_returns",
]


def test_every_key_has_a_statement():
    keys = set(registered())
    assert keys <= set(entry.queries()) and keys <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", COMPARED)
def test_same_rows_as_sql(spark, sf_dir, key):
    assert differences(entry.queries()[key](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[key]) == []


def test_entry_gives_one_panel(spark):
    assert entry.entry(spark).count() == 1


def test_shares_and_curves_hold_their_bounds(star):
    deciles = retention.value_deciles(star, RETAIL_PARAMS).orderBy("decile").collect()
    sizes = [r.customers for r in deciles]
    assert max(sizes) - min(sizes) <= 1 and sorted(sizes, reverse=True) == sizes
    assert deciles[-1].cumulative_pct == 100.0
    lorenz = concentration.lorenz_curve(star, RETAIL_PARAMS).orderBy("cumulative_customer_pct").collect()
    values = [r.cumulative_value_pct for r in lorenz]
    assert values == sorted(values) and values[-1] == 100.0
    for r in concentration.gini(star, RETAIL_PARAMS).collect():
        assert 0 <= r.gini_coefficient <= 1


HOT = [
    "kpi_panel", "region_customer_quality", "region_yoy", "channel_value_vs_volume", "category_mix_by_channel",
    "category_profitability", "top_products_by_profit", "value_deciles", "rfm_segment_summary", "cohort_retention_curve",
    "clv_percentiles", "topn_ladder", "gini", "order_header_rollup", "discount_allocation", "refund_proration",
    "customer_monthly_snapshot", "dq_fk_orphans", "dq_reconcile_groups", "high_value_category_mix",
]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory, sf_dir):
    """The small tables with one customer, one order and one part holding a third each."""
    out = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        src = f"'{sf_dir}/{t}.parquet'"
        query = f"SELECT * FROM {src}"
        if t == "orders":
            query = f"SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 17 ELSE o_custkey END AS o_custkey) FROM {src}"
        if t == "lineitem":
            hot = f"(SELECT MIN(o_orderkey) FROM '{sf_dir}/orders.parquet')"
            query = (
                "SELECT * EXCLUDE (rn) REPLACE (CASE WHEN rn % 3 = 1 THEN " + hot + " ELSE l_orderkey END AS l_orderkey,"
                " CASE WHEN rn % 3 = 2 THEN 7 ELSE l_partkey END AS l_partkey,"
                " CAST(l_extendedprice AS DOUBLE) AS l_extendedprice)"
                f" FROM (SELECT *, ROW_NUMBER() OVER () AS rn FROM {src})"
            )
        con.execute(f"COPY ({query}) TO '{out}/{t}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("key", HOT)
def test_hot_keys_give_the_same_rows(spark, hot_dir, key):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{hot_dir}/{t}.parquet'")
    # Small joins are planned as on large tables: shuffled, not broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(entry.queries()[key](spark, hot_dir), con, entry.oracle_sql()[key]) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_ties_on_one_value_have_gini_zero(spark):
    df = spark.createDataFrame([(i, 500) for i in range(10)], "customer_key bigint, clv_c bigint")

    class Flat:
        held = {"buyer_totals": df.select("customer_key", F.lit(1).alias("orders"), F.col("clv_c").alias("net_c"),
                                          F.lit(0).alias("refund_c"), F.lit(0).alias("gross_c"),
                                          F.lit(0).alias("discount_c"), F.lit(0).alias("units"),
                                          F.lit(0).alias("units_returned"))}

        def customers(self, *cols):
            return df.select(*cols)

    assert {r.gini_coefficient for r in concentration.gini(Flat(), RETAIL_PARAMS).collect()} == {0.0}


def test_verdicts_fail_where_two_paths_differ(spark, sf_dir):
    from merchlens import RetailStar
    from merchlens.plans.verdicts import VERDICTS

    class Doubled(RetailStar):
        """Headers that say twice what their lines do."""

        def orders(self, *cols, during=None):
            more = [c for c in ("net_c",) if c not in cols]
            return super().orders(*cols, *more, during=during).withColumn("net_c", F.col("net_c") * 2).select(*cols)

    found = {r.statement: r.verdict for r in VERDICTS["verdicts_revenue"](Doubled(spark, sf_dir), RETAIL_PARAMS).collect()}
    assert found["categories sum to the header total"] == found["path line_by_category"] == "FAIL"
    assert found["years sum to the header total"] == "PASS"
    # What is not there decides nothing in favour.
    none = Doubled(spark, sf_dir, status="no such status")
    none.__dict__["_bounds"] = RetailStar(spark, sf_dir)._bounds
    assert {r.verdict for r in VERDICTS["verdicts_clv"](none, RETAIL_PARAMS).collect()} >= {"FAIL"}
