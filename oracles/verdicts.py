"""The measures the report verdicts state, from the base tables; all verdicts must be PASS."""

from oracles.reports import SQL as REPORT

_NET = "SELECT SUM(net) FROM sale"
_REFUND = "SELECT SUM(refund) FROM back"
_UNITS_BACK = "SELECT SUM(back) FROM back"
_VALUE = "SELECT SUM(value) FROM purse"
_ALL = "SELECT COUNT(*) FROM purse"
_BUYERS = "SELECT COUNT(*) FROM purse WHERE orders > 0"
_POSITIVE = "SELECT COUNT(*) FROM purse WHERE value > 0"
_AGAIN = "SELECT COUNT(*) FROM purse WHERE orders > 1"
_PROFIT = "SELECT SUM(net) - SUM(qty * cost) FROM sale"


def _of(report: str, column: str) -> str:
    return f"SELECT {column} FROM ({REPORT[report]})"


_MEASURES: dict[str, list[tuple[str, str]]] = {
    "executive": [
        ("order net revenue equals line net", _NET),
        ("net revenue agrees with the panel", _VALUE),
        ("gross margin agrees with the panel", _of("kpi_gross_margin_pct", "gross_margin_pct")),
        ("order value equals line net per order", _of("kpi_aov", "avg_order_value")),
        ("discount impact equals the line path", "SELECT {pct(SUM(disc), SUM(gross), 2)} FROM sale"),
        ("return rate agrees with the panel", "SELECT {pct(SUM(units_back), SUM(units), 2)} FROM purse"),
        ("repeat rate agrees with the panel",
         "SELECT {pct(COUNT(*) FILTER (WHERE orders > 1), COUNT(*), 2)} FROM purse"),
    ],
    "revenue": [
        ("years sum to the header total", _NET),
        ("channels sum to the header total", _NET),
        ("categories sum to the header total", _NET),
        ("channel and category variance agree",
         "SELECT SUM(CASE year(day) WHEN 2000 THEN net WHEN 1999 THEN -net ELSE 0 END) FROM sale"),
        ("path header_by_channel", _NET),
        ("path header_by_year", _NET),
        ("path header_total", _NET),
        ("path line_by_category", _NET),
    ],
    "product": [
        ("categories sum to total profit", _PROFIT),
        ("products sum to total profit", _PROFIT),
        ("category returns sum to all returns", _REFUND),
        ("divergence covers revenue and profit", _PROFIT),
        ("unit positions cover all units", "SELECT SUM(qty) FROM sale"),
        ("quadrants cover all revenue", _NET),
    ],
    "geography": [
        ("regions sum to the header total", _NET),
        ("national value per customer", "SELECT {avg(SUM(net), COUNT(*), 2)} FROM purse"),
        ("regional repeat customers", _AGAIN),
        ("regional years sum to the years", "SELECT SUM(net) FROM sale WHERE year(day) = 1997"),
        ("quadrants cover all revenue", _NET),
    ],
    "marketing": [
        ("channels cover revenue and customers", _NET),
        ("channel repeat customers", _AGAIN),
        ("campaign types cover attributed revenue", "SELECT SUM(net) FROM sale WHERE day IN (SELECT d FROM promo_day)"),
        ("channel shares sum to 100", "SELECT 100"),
        ("category mix covers all revenue", _NET),
        ("quadrants cover all customers", _ALL),
    ],
    "retention": [
        ("the split covers customers and revenue", _NET),
        ("tiers cover customers and net revenue", _VALUE),
        ("deciles cover the buyers' value", _VALUE),
        ("repeat revenue agrees with the ledger", "SELECT SUM(net) FROM purse WHERE orders > 1"),
        ("90-day rate lies below the lifetime rate", _of("repeat_90d_rate", "repeat_90d_rate_pct")),
        ("the top decile is a tenth of the buyers", "SELECT CEIL(COUNT(*) / 10.0) FROM purse WHERE orders > 0"),
    ],
    "returns": [
        ("the overview covers all returns", _REFUND),
        ("reasons sum to all refunds", _REFUND),
        ("categories sum to all refunds", _REFUND),
        ("bands cover all buyers", _BUYERS),
        ("regions cover all returned units", _UNITS_BACK),
        ("channels cover all returned units", _UNITS_BACK),
        ("realised leakage is refunds and discounts",
         "SELECT (SELECT SUM(refund) FROM back) + SUM(disc) FROM sale"),
    ],
    "rfm": [
        ("frequency bands cover all buyers", _BUYERS),
        ("recency and value use five levels", "SELECT 5"),
        ("every buyer has a segment", _BUYERS),
        ("segment value reconciles", _VALUE),
    ],
    "cohorts": [
        ("cohorts cover all customers", _ALL),
        ("first-month activity counted directly",
         "SELECT COUNT(DISTINCT w.cust) FROM who w JOIN hdr h ON h.cust = w.cust"
         " AND date_trunc('month', h.day) = date_trunc('month', w.signup)"),
        ("every buyer is engaged in the first month", _BUYERS),
        ("classes cover revenue and orders", _NET),
        ("classes cover customer value", _VALUE),
        ("every scored buyer has a cohort", _BUYERS),
    ],
    "clv": [
        ("customer value is net revenue", "SELECT (SELECT SUM(net) FROM sale) - SUM(refund) FROM back"),
        ("snapshot and facts give one value", "SELECT SUM(value) FROM snap WHERE me = (SELECT horizon FROM span)"),
        ("tiers cover all customers", _ALL),
        ("classes cover positive customers", _POSITIVE),
        ("segments cover all value", _VALUE),
    ],
    "concentration": [
        ("the base covers customers and value", _VALUE),
        ("the ladder never falls",
         _of("topn_ladder", "top_50_pct") + " WHERE analytical_basis = 'Primary - complete portfolio'"),
        ("decile share agrees with the decile report", _of("top_decile_share", "top_decile_share_pct")),
        ("the Lorenz curve ends at 100", "SELECT 100"),
        ("Gini lies in range and falls for buyers",
         "SELECT {rnd(g, 2)} FROM (" + _of("gini", "gini_coefficient AS g")
         + " WHERE analytical_basis = 'Primary - complete portfolio')"),
    ],
    "behaviour": [
        ("the population has positive value", _POSITIVE),
        ("population and exclusions make the base", _ALL),
        ("no feature is missing", "SELECT 0"),
        ("cadence exists exactly from two orders on", "SELECT 0"),
        ("breadth and cadence lie in range", "SELECT MAX(cats) FROM traits"),
        ("classes cover the population", _POSITIVE),
        ("cells cover their strata", "SELECT COUNT(*) FROM traits WHERE orders BETWEEN 3 AND 6"),
        ("cadence leaves single orders out", "SELECT COUNT(cadence) FROM traits"),
        ("basket measures cover the population", _POSITIVE),
        ("segments cover the population", _POSITIVE),
    ],
    "portfolio": [
        ("one row per customer", _ALL),
        ("the portfolio covers all value", _VALUE),
        ("no classification drifts", "SELECT 0"),
        ("overlaps lie within their sets",
         _of("method_convergence", "customers") + " WHERE method_or_overlap = 'A and B and C'"),
    ],
}


def _table(module: str) -> str:
    rows = (
        f"SELECT '{module}' AS module, CAST({i} AS INTEGER) AS check_no, '" + text.replace("'", "''")
        + "' AS statement, CAST(ROUND(CAST((" + sql + ") AS DOUBLE), 2) AS DOUBLE) AS measure, 'PASS' AS verdict"
        for i, (text, sql) in enumerate(_MEASURES[module], start=1)
    )
    return " UNION ALL ".join(rows)


SQL = {f"verdicts_{m}": _table(m) for m in _MEASURES}
