import datetime as dt

import pytest
from pyspark.sql import functions as F

from merchlens import RetailStar, StoredStar
from merchlens.params import RETAIL_PARAMS
from merchlens.plans import executive, geography, marketing, revenue, rfm
from merchlens.schema import TABLES, table_schema
from merchlens.session import scratch_path, scratch_root, stage
from merchlens.sources import files, publish, versions
from merchlens.sources.publish import publish_star, publish_table
from merchlens.sources.star import read_star_table, stored_form


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    root = scratch_path(spark, "stored")
    rows = publish_star(RetailStar(spark, sf_dir), root)
    assert all(rows[t] > 0 for t in TABLES)
    return StoredStar(spark, root)


@pytest.mark.parametrize(
    "plan", [executive.kpi_panel, marketing.channel_volume, marketing.campaign_type_performance, rfm.rfm_segment_summary]
)
def test_stored_and_derived_star_give_the_same_report(star, stored, plan):
    a, b = plan(star, RETAIL_PARAMS).collect(), plan(stored, RETAIL_PARAMS).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_final_rows_are_the_last_snapshot(star, stored):
    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    cols = ["customer_key", "recency_days", "cumulative_orders_to_date", "cumulative_net_c"]
    assert rows(star.final_buyers().select(cols)) == rows(stored.final_buyers().select(cols))
    more = [*cols, "is_active_flag", "is_repeat_customer_flag"]

    def key(df):
        return sorted(str(tuple(r)) for r in df.select(more).collect())

    assert key(star.final_snapshot()) == key(stored.final_snapshot())


def test_csv_keeps_the_word_none_and_types(spark, star):
    root = scratch_path(spark, "csv-campaign")
    publish_table(stored_form(star, "dim_campaign"), root, "dim_campaign", fmt="csv")
    df = read_star_table(spark, root, "dim_campaign", "csv")
    assert [f.dataType for f in df.schema] == [f.dataType for f in table_schema("dim_campaign")]
    assert df.filter("discount_depth = 'None'").count() == df.filter("campaign_name like 'Spring%'").count() > 0
    assert df.filter("is_active_flag").count() == df.count()


def _shown(spark, root, name):
    return spark.read.parquet(versions.current(spark, f"{root}/{name}").folder).count()


def test_publish_leaves_the_old_table_when_the_count_is_wrong(spark):
    root = scratch_path(spark, "swap")
    two, none = spark.range(2), spark.range(0)
    assert publish_table(two, root, "t") == 2
    for bad, expected in ((spark.range(5), 4), (none, None)):
        with pytest.raises(ValueError):
            publish_table(bad, root, "t", expected=expected)
        assert _shown(spark, root, "t") == 2
    assert publish_table(spark.range(3), root, "t", expected=3) == 3
    assert _shown(spark, root, "t") == 3
    # Nothing is left of what was refused.
    assert len([n for n in files.names(spark, f"{root}/t") if n.startswith("v")]) == 2


@pytest.mark.parametrize("step", ["write", "commit", "torn"])
def test_a_failing_step_leaves_the_old_version_readable(spark, monkeypatch, step):
    root = scratch_path(spark, "failing")
    publish_table(spark.range(2), root, "t")

    def fails(*args, **how):
        raise OSError("no space left")

    def torn(spark, path, text, real=files.write_new):
        real(spark, path, text[: len(text) // 2])
        raise OSError("no space left")

    if step == "write":
        monkeypatch.setattr(publish, "_write", fails)
    else:
        monkeypatch.setattr(files, "write_new", fails if step == "commit" else torn)
    with pytest.raises(OSError, match="no space"):
        publish_table(spark.range(7), root, "t")
    monkeypatch.undo()
    assert _shown(spark, root, "t") == 2
    assert publish_table(spark.range(9), root, "t") == 9 and _shown(spark, root, "t") == 9
    versions.collect(spark, f"{root}/t", keep=1, grace_s=0)
    assert len([n for n in files.names(spark, f"{root}/t") if n.startswith("v")]) == 1 and _shown(spark, root, "t") == 9


def test_of_two_writers_the_second_fails(spark, monkeypatch):
    root = scratch_path(spark, "two")
    publish_table(spark.range(2), root, "t")
    real = publish._write

    def overtaken(df, *args):
        monkeypatch.setattr(publish, "_write", real)
        publish_table(spark.range(5), root, "t")
        return real(df, *args)

    monkeypatch.setattr(publish, "_write", overtaken)
    with pytest.raises(versions.ConcurrentPublish):
        publish_table(spark.range(7), root, "t")
    assert _shown(spark, root, "t") == 5
    assert len([n for n in files.names(spark, f"{root}/t") if n.startswith("v")]) == 2


def test_a_reader_keeps_its_version_and_old_ones_are_collected(spark, star):
    root = scratch_path(spark, "kept")
    reasons = stored_form(star, "dim_return_reason")
    publish_table(reasons, root, "dim_return_reason")
    before = StoredStar(spark, root).table("dim_return_reason")
    publish_table(reasons.filter("return_reason_key < 3"), root, "dim_return_reason")
    assert before.count() == 6 and StoredStar(spark, root).table("dim_return_reason").count() == 2
    publish_table(reasons.filter("return_reason_key < 2"), root, "dim_return_reason", keep=1)
    found = files.names(spark, f"{root}/dim_return_reason")
    assert len([n for n in found if n.startswith("v")]) == 1
    assert files.names(spark, f"{root}/dim_return_reason/_versions") == ["000000003"]


@pytest.mark.parametrize("plan", [revenue.variance_by_channel, revenue.variance_by_category, geography.region_yoy])
def test_reports_of_a_period_read_its_months_only(star, stored, plan):
    told = plan(stored, RETAIL_PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in told, told
    assert sorted(map(tuple, plan(star, RETAIL_PARAMS).collect())) == sorted(map(tuple, plan(stored, RETAIL_PARAMS).collect()))


def test_the_final_snapshot_is_one_partition(stored):
    assert stored.final_snapshot().select(F.input_file_name().alias("f")).distinct().count() == 1
    scan = stored.final_snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in scan


def test_a_period_gives_the_rows_of_its_days(star, stored):
    import datetime as dt

    days = (dt.date(1996, 2, 10), dt.date(1996, 5, 3))
    for source in (star, stored):
        for read, date in ((source.orders, "order_date"), (source.lines, "order_date"), (source.returns, "return_date")):
            part = read("order_key", date, during=days)
            whole = read("order_key", date).filter(F.col(date).between(*map(F.lit, days)))
            assert part.count() == whole.count() > 0 and part.exceptAll(whole).count() == 0


def test_two_channel_names_with_one_key_raise(spark, star):
    from merchlens.sources.retail import _channels

    # Two strings with the same CRC-32.
    names = spark.createDataFrame([("plumless",), ("buckeroo",), ("other",)], "channel_name string")
    with pytest.raises(Exception, match="share a key"):
        _channels(names, "k", "g", "x").collect()


def test_empty_or_unknown_table_is_refused(spark):
    root = scratch_path(spark, "empty")
    spark.createDataFrame([], table_schema("dim_return_reason")).write.parquet(f"{root}/dim_return_reason")
    with pytest.raises(ValueError, match="empty"):
        read_star_table(spark, root, "dim_return_reason")
    with pytest.raises(ValueError, match="unknown"):
        read_star_table(spark, root, "dim_nothing")


def test_staged_tables_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == named.rstrip("/")
    df = stage(spark.range(10), "ten")
    assert df.count() == 10 and df.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(named.strip("/"))


def test_channel_keys_do_not_collide(star):
    for df, key in ((star.sales_channels(), "sales_channel_key"), (star.marketing_channels(), "marketing_channel_key")):
        assert df.count() == df.select(key).distinct().count() == 5


def test_staged_tables_can_be_removed(spark):
    from pathlib import Path

    from merchlens.session import clear_scratch, stage, unstage

    a, b = stage(spark.range(5), "first"), stage(spark.range(7), "second")
    assert Path(a._staged_at).exists() and a.count() + b.count() == 12
    unstage(a)
    assert not Path(a._staged_at).exists() and Path(b._staged_at).exists() and b.count() == 7
    clear_scratch()
    assert not Path(b._staged_at).exists()


@pytest.mark.parametrize("status", [None, "F"])
def test_held_facts_are_those_that_were_not_held(spark, sf_dir, tmp_path, status):
    for name in ("orders", "lineitem", "customer", "part", "nation", "region"):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "orders":
            # Lines of every seventh order have none.
            df = df.filter("o_orderkey % 7 <> 0")
        if name == "lineitem":
            df = df.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 11 != 0, F.col("l_orderkey")))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    plain, held = RetailStar(spark, str(tmp_path), status), RetailStar(spark, str(tmp_path), status)
    held.hold_facts(orders=True, returns=True, products=True)
    assert set(held.held) == {"strays", "orders", "returns", "product_totals", "product_returns"}
    year = (dt.date(1996, 1, 1), dt.date(1996, 12, 31))
    for read in (
        lambda s: s.lines("order_line_key", "quantity", "net_c"),
        lambda s: s.lines("order_line_key", "unit_cost_c", "order_date", during=year),
        lambda s: s.lines("order_line_key", during=year),
        lambda s: s.orders("order_key", "customer_key", "order_date", "gross_c", "net_c", "shipping_c", "is_first_order"),
        lambda s: s.orders("geography_key", "campaign_key", "discount_c", during=year),
        lambda s: s.orders_by_sales_channel("year", during=year),
        lambda s: s.orders_by_customer(),
        lambda s: s.order_ledger(),
        lambda s: s.returns("product_key", "return_date", "refund_c", "fee_c"),
        lambda s: s.returns("return_reason_key", "return_quantity", during=year),
        lambda s: s.returns("customer_key", "refund_c"),
        lambda s: s.product_totals("category"),
        lambda s: s.product_returns(),
    ):
        a, b = read(plain), read(held)
        assert a.columns == b.columns and a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0


def test_verdicts_read_the_lines_a_few_times(spark, star, monkeypatch):
    from merchlens.plans import verdicts

    reads = []
    monkeypatch.setattr(RetailStar, "_counted", lambda self, *cols, f=RetailStar._counted, **k: reads.append(cols) or f(self, *cols, **k))
    rows = verdicts.VERDICTS["verdicts_product"](star, RETAIL_PARAMS).collect()
    assert len(rows) == 6 and all(r.verdict == "PASS" for r in rows)
    # Lines met orders eleven times.
    assert len(reads) <= 2
