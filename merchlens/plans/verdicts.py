"""Verdicts on the reports: every report against a second way to its totals.

Each module's reports are rolled up to one row of totals and compared with
totals taken from the facts by another path. Each such row is a scalar of the
one row that the verdicts are columns of, so they are decided by the plan and
nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.operators import customers as cust
from merchlens.operators.quality import FAIL, PASS
from merchlens.params import Params
from merchlens.plans import (
    behaviour,
    clv,
    cohorts,
    concentration,
    executive,
    geography,
    marketing,
    portfolio,
    product,
    retention,
    returns,
    revenue,
    rfm,
)
from merchlens.session import run_together, stage
from merchlens.sources.star import Star

# (statement, measure, holds)
Verdict = tuple[str, Column, Column]
CENT = 0.0051


def near(a: Column, b: Column | float, tolerance: float | Column = CENT) -> Column:
    """Whether two amounts agree; one that is missing agrees with none."""
    return F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def all_of(*conditions: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


# The three sets of high-value customers and their overlaps.
_SETS = ("A RFM Champions", "B Elite value class", "C Top value decile", "A and B", "A and C", "B and C", "A and B and C")


class Totals:
    """The columns of one row of totals, by name."""

    def __init__(self, name: str):
        self._name = name

    def __getitem__(self, column: str) -> Column:
        return F.col(self._name)[column]

    __getattr__ = __getitem__


class Frames:
    """Rows of totals that verdicts compare."""

    def __init__(self):
        self.made: dict[str, DataFrame] = {}

    def __call__(self, frames: dict[str, Callable[[], DataFrame]]) -> dict[str, Totals]:
        # Side by side, each stored as its one row: reports hold scalars of their own, which do not nest well.
        self.made = dict(zip(frames, run_together([lambda f=f: stage(f(), "totals") for f in frames.values()])))
        return {name: Totals(name) for name in frames}

    def row(self, star: Star) -> DataFrame:
        return star.spark.range(1).select(*[df.select(F.struct("*")).scalar().alias(name) for name, df in self.made.items()])


def _headers(star: Star) -> DataFrame:
    return star.orders("gross_c", "discount_c", "net_c").agg(
        F.count("*").alias("n"),
        (F.sum("net_c") / 100).alias("net"),
        (F.sum("discount_c") / 100).alias("discount"),
        (F.sum("gross_c") / 100).alias("gross"),
    )


def _lines(star: Star) -> DataFrame:
    return star.lines("net_c", "gross_c", "discount_c", "quantity").agg(
        (F.sum("net_c") / 100).alias("net"),
        (F.sum("gross_c") / 100).alias("gross"),
        (F.sum("discount_c") / 100).alias("discount"),
        F.sum("quantity").alias("units"),
    )


def _back(star: Star) -> DataFrame:
    return star.returns("refund_c", "return_quantity").agg(
        F.count("*").alias("n"), (F.sum("refund_c") / 100).alias("refund"), F.sum("return_quantity").alias("units")
    )


def _profit(star: Star) -> DataFrame:
    return star.product_totals().agg(
        (F.sum("net_c") / 100).alias("net"),
        (F.sum(F.col("net_c") - F.col("cost_c")) / 100).alias("profit"),
        F.sum("units").alias("units"),
    )


def _people(star: Star) -> DataFrame:
    o, v = F.col("orders"), F.col("value_c")
    return cust.customer_ledger(star).agg(
        F.count("*").alias("n"),
        F.count_if(o > 0).alias("buyers"),
        F.count_if(o > 1).alias("again"),
        F.count_if(v > 0).alias("positive"),
        F.count_if((v == 0) & (o > 0)).alias("zero"),
        (F.sum("value_c") / 100).alias("value"),
        (F.sum(F.when(o > 1, F.col("net_c")).otherwise(0)) / 100).alias("again_net"),
        (F.sum("net_c") / 100).alias("net"),
        F.sum("units").alias("units"),
        F.sum("units_returned").alias("units_back"),
    )


def _sums(df: DataFrame, *columns: str) -> DataFrame:
    """Row count and totals of a report."""
    return df.agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in columns])


def _executive(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    r = rows(
        {
            "panel": lambda: executive.kpi_panel(s, p),
            "onr": lambda: executive.kpi_order_net_revenue(s, p),
            "net": lambda: executive.kpi_net_revenue(s, p),
            "margin": lambda: executive.kpi_gross_margin_pct(s, p),
            "aov": lambda: executive.kpi_aov(s, p),
            "disc": lambda: executive.kpi_discount_impact_pct(s, p),
            "ret": lambda: executive.kpi_return_rate_pct(s, p),
            "rep": lambda: executive.kpi_repeat_purchase_rate_pct(s, p),
            "lines": lambda: _lines(s),
        }
    )
    panel, ln = r["panel"], r["lines"]
    onr = r["onr"].order_net_revenue
    yield "order net revenue equals line net", onr, all_of(near(onr, ln.net), near(onr, panel.order_net_revenue))
    yield "net revenue agrees with the panel", r["net"].net_revenue, near(r["net"].net_revenue, panel.net_revenue)
    m = r["margin"].gross_margin_pct
    yield "gross margin agrees with the panel", m, near(m, panel.gross_margin_pct)
    a = r["aov"].avg_order_value
    yield "order value equals line net per order", a, near(a, ln.net / panel.total_orders, 0.011)
    d = r["disc"].discount_impact_pct
    yield "discount impact equals the line path", d, near(d, 100 * ln.discount / ln.gross, 0.011)
    x = r["ret"].return_rate_pct
    yield "return rate agrees with the panel", x, near(x, panel.return_rate_pct)
    y = r["rep"].repeat_purchase_rate_pct
    yield "repeat rate agrees with the panel", y, near(y, panel.repeat_purchase_rate_pct)


def _revenue(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    paths = revenue.revenue_path_reconciliation(s, p)
    wide = paths.groupBy().pivot(
        "path", ["header_total", "header_by_year", "header_by_channel", "line_by_category"]
    ).agg(F.first("order_net_revenue"))
    r = rows(
        {
            "head": lambda: _headers(s),
            "year": lambda: _sums(revenue.revenue_by_year(s, p), "order_net_revenue"),
            "chan": lambda: _sums(revenue.revenue_by_sales_channel(s, p), "order_net_revenue"),
            "cat": lambda: _sums(revenue.revenue_by_category(s, p), "order_net_revenue"),
            "vchan": lambda: _sums(revenue.variance_by_channel(s, p), "yoy_change"),
            "vcat": lambda: _sums(revenue.variance_by_category(s, p), "yoy_change"),
            "paths": lambda: wide,
        }
    )
    net = r["head"].net
    for label, key in (("years", "year"), ("channels", "chan"), ("categories", "cat")):
        got = r[key].order_net_revenue
        yield f"{label} sum to the header total", got, near(got, net, 0.05)
    a, b = r["vchan"].yoy_change, r["vcat"].yoy_change
    yield "channel and category variance agree", a, near(a, b, 0.05)
    for path in ("header_by_channel", "header_by_year", "header_total", "line_by_category"):
        yield f"path {path}", r["paths"][path], near(r["paths"][path], net)


def _product(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    per_product = s.product_totals().agg((F.sum(F.col("net_c") - F.col("cost_c")) / 100).alias("profit"))
    r = rows(
        {
            "econ": lambda: _profit(s),
            "back": lambda: _back(s),
            "cat": lambda: _sums(product.category_profitability(s, p), "revenue", "gross_profit"),
            "each": lambda: per_product,
            "ret": lambda: _sums(product.category_return_performance(s, p), "units_returned", "revenue_returned"),
            "div": lambda: _sums(product.category_value_divergence(s, p), "revenue", "gross_profit"),
            "vol": lambda: _sums(product.category_premium_volume(s, p), "units_sold"),
            "quad": lambda: _sums(product.category_quadrants(s, p), "revenue"),
            "lines": lambda: _lines(s),
        }
    )
    net, profit, ln = r["econ"].net, r["econ"].profit, r["lines"]
    c = r["cat"]
    yield "categories sum to total profit", c.gross_profit, near(c.gross_profit, profit, 0.05)
    yield "products sum to total profit", r["each"].profit, near(r["each"].profit, profit)
    ok = all_of(r["ret"].units_returned == r["back"].units, near(r["ret"].revenue_returned, r["back"].refund, 0.05))
    yield "category returns sum to all returns", r["ret"].revenue_returned, ok
    ok = all_of(near(r["div"].revenue, net, 0.05), near(r["div"].gross_profit, profit, 0.05))
    yield "divergence covers revenue and profit", r["div"].gross_profit, ok
    yield "unit positions cover all units", r["vol"].units_sold, r["vol"].units_sold == ln.units
    yield "quadrants cover all revenue", r["quad"].revenue, near(r["quad"].revenue, ln.net, 0.05)


def _geography(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    y1, y2, y3 = p.growth_years
    per_year = s.orders("order_date", "net_c").agg(
        *[
            (F.sum(F.when(F.year("order_date") == y, F.col("net_c")).otherwise(0)) / 100).alias(f"rev_year_{i}")
            for i, y in enumerate((y1, y2, y3), start=1)
        ]
    )
    quality = geography.region_customer_quality(s, p)
    r = rows(
        {
            "head": lambda: _headers(s),
            "people": lambda: _people(s),
            "reg": lambda: _sums(geography.region_revenue(s, p), "order_net_revenue"),
            "rpc": lambda: geography.region_rpc_index(s, p).agg(F.max("national_rpc").alias("v")),
            "rep": lambda: quality.agg(
                F.sum(F.round(F.col("repeat_rate_pct") * F.col("total_customers") / 100)).alias("again")
            ),
            "yoy": lambda: _sums(geography.region_yoy(s, p), "rev_year_1", "rev_year_2", "rev_year_3"),
            "years": lambda: per_year,
            "quad": lambda: _sums(geography.region_quadrants(s, p), "revenue"),
        }
    )
    net, people = r["head"].net, r["people"]
    got = r["reg"].order_net_revenue
    yield "regions sum to the header total", got, near(got, net, 0.05)
    yield "national value per customer", r["rpc"].v, near(r["rpc"].v, net / people.n, 0.011)
    # The regional rates are rounded to a tenth of a percent.
    yield "regional repeat customers", people.again, F.abs(r["rep"].again - people.again) <= people.n / 1000 + 5
    ok = all_of(*[near(r["yoy"][f"rev_year_{i}"], r["years"][f"rev_year_{i}"], 0.05) for i in (1, 2, 3)])
    yield "regional years sum to the years", r["yoy"].rev_year_3, ok
    yield "quadrants cover all revenue", r["quad"].revenue, near(r["quad"].revenue, net, 0.05)


def _marketing(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    quality = marketing.channel_customer_quality(s, p)
    attributed = s.orders("campaign_key", "net_c").filter("campaign_key is not null")
    r = rows(
        {
            "head": lambda: _headers(s),
            "people": lambda: _people(s),
            "vol": lambda: _sums(marketing.channel_volume(s, p), "order_net_revenue", "customers_acquired"),
            "rep": lambda: quality.agg(
                F.sum(F.round(F.col("repeat_rate_pct") * F.col("acquired_customers") / 100)).alias("again")
            ),
            "camp": lambda: _sums(marketing.campaign_type_performance(s, p), "campaign_revenue_gross"),
            "attr": lambda: attributed.agg((F.sum("net_c") / 100).alias("net")),
            "gap": lambda: _sums(marketing.channel_value_vs_volume(s, p), "revenue_share_pct", "customer_share_pct"),
            "mix": lambda: _sums(marketing.category_mix_by_channel(s, p), "channel_category_revenue"),
            "quad": lambda: _sums(marketing.channel_quadrants(s, p), "customers"),
        }
    )
    net, people, vol = r["head"].net, r["people"], r["vol"]
    ok = all_of(near(vol.order_net_revenue, net, 0.05), vol.customers_acquired == people.n)
    yield "channels cover revenue and customers", vol.order_net_revenue, ok
    yield "channel repeat customers", people.again, F.abs(r["rep"].again - people.again) <= people.n / 1000 + 5
    got = r["camp"].campaign_revenue_gross
    yield "campaign types cover attributed revenue", got, near(got, r["attr"].net, 0.05)
    shares = r["gap"]
    half = 0.05 * shares.rows + 1e-6
    ok = all_of(near(shares.revenue_share_pct, 100.0, half), near(shares.customer_share_pct, 100.0, half))
    yield "channel shares sum to 100", F.lit(100.0), ok
    got = r["mix"].channel_category_revenue
    yield "category mix covers all revenue", got, near(got, net, 0.05)
    yield "quadrants cover all customers", r["quad"].customers, r["quad"].customers == people.n


def _retention(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    split = retention.customer_portfolio_split(s, p)
    again = F.when(F.col("segment") == "Repeat (2+)", F.col("order_net_revenue"))
    deciles = retention.value_deciles(s, p)
    r = rows(
        {
            "people": lambda: _people(s),
            "split": lambda: split.agg(F.sum("customers").alias("n"), F.sum("order_net_revenue").alias("net")),
            "tiers": lambda: _sums(retention.frequency_tier_value(s, p), "customers", "net_revenue"),
            "dec": lambda: deciles.agg(
                F.sum("net_revenue").alias("value"),
                F.sum("customers").alias("n"),
                F.max(F.when(F.col("decile") == 1, F.col("customers"))).alias("top"),
            ),
            "once": lambda: retention.repeat_vs_one_time(s, p).agg(F.sum(again).alias("net")),
            "quick": lambda: retention.repeat_90d_rate(s, p),
        }
    )
    people = r["people"]
    ok = all_of(r["split"].n == people.n, near(r["split"].net, people.net, 0.05))
    yield "the split covers customers and revenue", r["split"].net, ok
    ok = all_of(r["tiers"].customers == people.n, near(r["tiers"].net_revenue, people.value, 0.05))
    yield "tiers cover customers and net revenue", r["tiers"].net_revenue, ok
    yield "deciles cover the buyers' value", r["dec"].value, near(r["dec"].value, people.value, 0.05)
    yield "repeat revenue agrees with the ledger", r["once"].net, near(r["once"].net, people.again_net)
    rate = r["quick"].repeat_90d_rate_pct
    yield "90-day rate lies below the lifetime rate", rate, all_of(rate > 0, rate <= 100 * people.again / people.buyers)
    yield "the top decile is a tenth of the buyers", r["dec"].top, r["dec"].top == F.ceil(people.buyers / 10)


def _returns(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    realized = F.when(F.col("leakage_class") == "Realized", F.col("dollars"))
    r = rows(
        {
            "head": lambda: _headers(s),
            "back": lambda: _back(s),
            "people": lambda: _people(s),
            "over": lambda: returns.returns_overview(s, p),
            "why": lambda: _sums(returns.return_reasons(s, p), "revenue_returned"),
            "cat": lambda: _sums(returns.category_return_drivers(s, p), "revenue_returned"),
            "bands": lambda: _sums(returns.return_rate_bands(s, p), "customers"),
            "region": lambda: _sums(returns.region_return_rate(s, p), "units_returned"),
            "chan": lambda: _sums(returns.channel_return_rate(s, p), "units_returned"),
            "leak": lambda: returns.value_leakage_ranked(s, p).agg(F.sum(realized).alias("v")),
        }
    )
    back, over = r["back"], r["over"]
    ok = all_of(over.total_returns == back.n, over.units_returned == back.units)
    yield "the overview covers all returns", over.revenue_refunded, all_of(ok, near(over.revenue_refunded, back.refund))
    for label, key in (("reasons", "why"), ("categories", "cat")):
        got = r[key].revenue_returned
        yield f"{label} sum to all refunds", got, near(got, back.refund, 0.05)
    yield "bands cover all buyers", r["bands"].customers, r["bands"].customers == r["people"].buyers
    for label, key in (("regions", "region"), ("channels", "chan")):
        yield f"{label} cover all returned units", r[key].units_returned, r[key].units_returned == back.units
    got = r["leak"].v
    yield "realised leakage is refunds and discounts", got, near(got, back.refund + r["head"].discount, 0.05)


def _rfm(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    scores = rfm.rfm_score_distribution(s, p)
    r = rows(
        {
            "people": lambda: _people(s),
            "score": lambda: scores.agg(
                F.sum("customers").alias("n"),
                F.count_distinct("r_score").alias("r"),
                F.count_distinct("m_score").alias("m"),
                F.count_if(~F.col("f_score").between(1, 5)).alias("odd"),
            ),
            "seg": lambda: _sums(rfm.rfm_segment_summary(s, p).filter("segment is not null"), "customers", "net_revenue"),
            "rec": lambda: rfm.rfm_reconciliation(s, p),
        }
    )
    people, score = r["people"], r["score"]
    yield "frequency bands cover all buyers", score.n, all_of(score.n == people.buyers, score.odd == 0)
    yield "recency and value use five levels", score.r, all_of(score.r == 5, score.m == 5)
    yield "every buyer has a segment", r["seg"].customers, r["seg"].customers == people.buyers
    ok = all_of(r["rec"].regression_result == PASS, near(r["rec"].rfm_net_revenue, people.value))
    yield "segment value reconciles", r["rec"].rfm_net_revenue, ok


def _cohorts(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    base = cohorts.cohort_base(s, p)
    same_month = (
        s.orders("customer_key", "order_date")
        .select("customer_key", F.trunc("order_date", "MM").alias("m"))
        .distinct()
        .join(s.customers("customer_key", "signup_date"), "customer_key")
        .filter(F.col("m") == F.trunc("signup_date", "MM"))
    )
    r = rows(
        {
            "people": lambda: _people(s),
            "head": lambda: _headers(s),
            "base": lambda: _sums(base, "cohort_customers"),
            "age0": lambda: cohorts.cohort_retention(s, p).filter("age_months = 0").agg(F.sum("active_customers").alias("n")),
            "same": lambda: same_month.agg(F.count("*").alias("n")),
            "eng": lambda: cohorts.engagement_curve(s, p).filter("age_months = 0"),
            "rev": lambda: _sums(cohorts.cohort_revenue(s, p), "order_net_revenue", "orders"),
            "val": lambda: _sums(cohorts.cohort_customer_value(s, p), "net_revenue", "customers"),
            "mix": lambda: cust.rfm_segments(s, money=False).join(s.customers("customer_key", "signup_date"), "customer_key").agg(
                F.count("*").alias("n")
            ),
        }
    )
    people = r["people"]
    yield "cohorts cover all customers", r["base"].cohort_customers, r["base"].cohort_customers == people.n
    yield "first-month activity counted directly", r["age0"].n, r["age0"].n == r["same"].n
    eng = r["eng"]
    ok = all_of(eng.buyers_at_age == eng.engaged_customers, eng.engaged_customers == people.buyers)
    yield "every buyer is engaged in the first month", eng.buyers_at_age, ok
    ok = all_of(near(r["rev"].order_net_revenue, r["head"].net, 0.05), r["rev"].orders == r["head"].n)
    yield "classes cover revenue and orders", r["rev"].order_net_revenue, ok
    ok = all_of(near(r["val"].net_revenue, people.value, 0.05), r["val"].customers == people.n)
    yield "classes cover customer value", r["val"].net_revenue, ok
    yield "every scored buyer has a cohort", r["mix"].n, r["mix"].n == people.buyers


def _clv(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    last = s.snapshot().filter(F.col("month_end") == F.lit(s.horizon))
    r = rows(
        {
            "people": lambda: _people(s),
            "head": lambda: _headers(s),
            "back": lambda: _back(s),
            "snap": lambda: last.agg((F.sum("cumulative_net_c") / 100).alias("v")),
            "tiers": lambda: _sums(clv.clv_value_tiers(s, p), "customers"),
            "classes": lambda: _sums(clv.clv_value_classes(s, p), "customers"),
            "seg": lambda: _sums(clv.clv_by_rfm_segment(s, p), "total_historical_clv"),
        }
    )
    people = r["people"]
    yield "customer value is net revenue", people.value, near(people.value, r["head"].net - r["back"].refund)
    yield "snapshot and facts give one value", r["snap"].v, near(r["snap"].v, people.value)
    yield "tiers cover all customers", r["tiers"].customers, r["tiers"].customers == people.n
    yield "classes cover positive customers", r["classes"].customers, r["classes"].customers == people.positive
    got = r["seg"].total_historical_clv
    yield "segments cover all value", got, near(got, people.value, 0.05)


def _concentration(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    full = F.col("analytical_basis") == concentration.FULL
    r = rows(
        {
            "people": lambda: _people(s),
            "bases": lambda: concentration.concentration_bases(s, p).filter(full),
            "ladder": lambda: concentration.topn_ladder(s, p).filter(full),
            "top": lambda: concentration.top_decile_share(s, p),
            "dec": lambda: retention.value_deciles(s, p).filter("decile = 1"),
            "lorenz": lambda: concentration.lorenz_curve(s, p).agg(F.max("cumulative_value_pct").alias("v")),
            "gini": lambda: concentration.gini(s, p).agg(
                F.max(F.when(full, F.col("gini_coefficient"))).alias("all"),
                F.max(F.when(~full, F.col("gini_coefficient"))).alias("buyers"),
            ),
        }
    )
    people, b = r["people"], r["bases"]
    ok = all_of(b.customers == people.n, near(b.total_historical_clv, people.value))
    yield "the base covers customers and value", b.total_historical_clv, ok
    steps = [F.lit(0.0), *[F.coalesce(r["ladder"][f"top_{x}_pct"], F.lit(0.0)) for x in concentration.LADDER], F.lit(100.0)]
    yield "the ladder never falls", steps[-2], all_of(*[x <= y for x, y in zip(steps, steps[1:])])
    top = r["top"].top_decile_share_pct
    yield "decile share agrees with the decile report", top, near(top, r["dec"].pct_of_net_revenue)
    yield "the Lorenz curve ends at 100", r["lorenz"].v, near(r["lorenz"].v, 100.0, 0.1)
    g = r["gini"]
    yield "Gini lies in range and falls for buyers", g["all"], all_of(g["buyers"] >= 0, g["buyers"] <= g["all"], g["all"] <= 1)


def _behaviour(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    feats = cust.behavioral_features(s, p)
    freq, gap = F.col("order_frequency"), F.col("purchase_cadence_days")
    in_strata = freq.isin(*p.breadth_strata)
    r = rows(
        {
            "people": lambda: _people(s),
            "f": lambda: feats.agg(
                F.count("*").alias("n"),
                (F.sum("clv_c") / 100).alias("value"),
                F.count_if(
                    F.col("category_breadth").isNull() | F.col("channel_breadth").isNull() | freq.isNull()
                ).alias("missing"),
                F.count_if((gap.isNull() & (freq > 1)) | (gap.isNotNull() & (freq == 1))).alias("odd_gap"),
                F.min("category_breadth").alias("lo"),
                F.max("category_breadth").alias("hi"),
                F.min("channel_breadth").alias("lo2"),
                F.max("channel_breadth").alias("hi2"),
                F.min(gap).alias("lo3"),
                F.count_if(in_strata).alias("strata"),
                F.count_if(gap.isNotNull()).alias("with_gap"),
                F.count_if(gap.isNotNull() & (freq == 1)).alias("single"),
            ),
            "pop": lambda: behaviour.behavior_population(s, p)
            .filter(F.col("population") != behaviour.BASE)
            .agg(F.sum("customers").alias("n")),
            "cats": lambda: s.products("category").agg(F.count_distinct("category").alias("n")),
            "chans": lambda: s.sales_channels().agg(F.count("*").alias("n")),
            "cls": lambda: _sums(behaviour.behavior_by_value_class(s, p), "customers"),
            "cells": lambda: _sums(behaviour.breadth_controlled(s, p), "customers"),
            "non": lambda: _sums(behaviour.non_explanatory_variables(s, p), "customers"),
            "seg": lambda: _sums(behaviour.behavior_by_rfm_segment(s, p), "customers"),
        }
    )
    people, f = r["people"], r["f"]
    yield "the population has positive value", f.n, f.n == people.positive
    yield "population and exclusions make the base", r["pop"].n, r["pop"].n == people.n
    yield "no feature is missing", f.missing, f.missing == 0
    yield "cadence exists exactly from two orders on", f.odd_gap, f.odd_gap == 0
    ok = all_of(f.lo >= 1, f.hi <= r["cats"].n, f.lo2 >= 1, f.hi2 <= r["chans"].n, F.coalesce(f.lo3, F.lit(0)) >= 0)
    yield "breadth and cadence lie in range", f.hi, ok
    yield "classes cover the population", r["cls"].customers, r["cls"].customers == f.n
    yield "cells cover their strata", r["cells"].customers, r["cells"].customers == f.strata
    yield "cadence leaves single orders out", f.with_gap, all_of(f.single == 0, f.with_gap > 0)
    yield "basket measures cover the population", r["non"].customers, r["non"].customers == f.n
    yield "segments cover the population", r["seg"].customers, r["seg"].customers == f.n


def _portfolio(s: Star, p: Params, rows: Frames) -> Iterable[Verdict]:
    folio = cust.held_portfolio(s, p, ranked=True)
    sets = portfolio.method_convergence(s, p).groupBy().pivot(
        "method_or_overlap",
        list(_SETS),
    ).agg(F.first("customers"))
    r = rows(
        {
            "people": lambda: _people(s),
            "rows": lambda: folio.agg(
                F.count("*").alias("n"),
                F.count_distinct("customer_key").alias("keys"),
                (F.sum("clv_c") / 100).alias("value"),
            ),
            "drift": lambda: portfolio.classification_drift(s, p),
            "sets": lambda: sets,
        }
    )
    people, whole = r["people"], r["rows"]
    yield "one row per customer", whole.n, all_of(whole.n == whole["keys"], whole["keys"] == people.n)
    yield "the portfolio covers all value", whole.value, near(whole.value, people.value)
    drift = r["drift"].rfm_segment_drift + r["drift"].value_class_drift
    yield "no classification drifts", drift, drift == 0
    a, b, c, ab, ac, bc, abc = (r["sets"][name] for name in _SETS)
    ok = all_of(ab <= F.least(a, b), ac <= F.least(a, c), bc <= F.least(b, c), abc > 0, abc <= F.least(ab, ac, bc))
    yield "overlaps lie within their sets", abc, ok


_MODULES = {
    "executive": _executive,
    "revenue": _revenue,
    "product": _product,
    "geography": _geography,
    "marketing": _marketing,
    "retention": _retention,
    "returns": _returns,
    "rfm": _rfm,
    "cohorts": _cohorts,
    "clv": _clv,
    "concentration": _concentration,
    "behaviour": _behaviour,
    "portfolio": _portfolio,
}


# Modules whose reports read the facts many times, and what they read more than once beside lines.
_MANY_READS = {
    "executive": {"orders": True, "returns": True, "products": True},
    "revenue": {"orders": True},
    "product": {"returns": True, "products": True},
    "returns": {"orders": True, "returns": True},
}
# Modules that have no use for the customers' totals, or one.
_NO_BUYERS = ("executive", "revenue", "product")


def _table(module: str, judge: Callable[[Star, Params, Frames], Iterable[Verdict]]) -> Callable[[Star, Params], DataFrame]:
    def verdicts(star: Star, params: Params) -> DataFrame:
        if module in _MANY_READS:
            star.hold_facts(**_MANY_READS[module])
        if module not in _NO_BUYERS:
            cust.hold_buyer_totals(star, breadth=module in ("behaviour", "portfolio"))
        frames = Frames()
        rows = [
            F.struct(
                F.lit(module).alias("module"),
                F.lit(i).cast("int").alias("check_no"),
                F.lit(statement).alias("statement"),
                F.round(F.coalesce(measure.cast("double"), F.lit(0.0)), 2).alias("measure"),
                # What cannot be decided does not hold.
                F.when(holds, PASS).otherwise(FAIL).alias("verdict"),
            )
            for i, (statement, measure, holds) in enumerate(judge(star, params, frames), start=1)
        ]
        return frames.row(star).select(F.inline(F.array(*rows)))

    return verdicts


VERDICTS = {f"verdicts_{m}": _table(m, judge) for m, judge in _MODULES.items()}
