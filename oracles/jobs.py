"""The model-building jobs and data-quality operators in SQL."""

_LINE_KEY = "concat_ws('-', ord, ln, part, supp, CAST(gross * 100 AS BIGINT))"

MODEL: dict[str, str] = {
    "calendar_dimension": """
        SELECT {i(strftime(d, '%Y%m%d'))} AS date_key, d AS full_date, {i(year(d))} AS year, {i(quarter(d))} AS quarter,
               {i(month(d))} AS month, monthname(d) AS month_name, {i(weekofyear(d))} AS week_of_year,
               {i(isodow(d))} AS day_of_week, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend,
               d IN (SELECT d FROM feasts) AS holiday_flag, {i(quarter(d))} AS fiscal_quarter,
               {i(year(d))} AS fiscal_year, s.season,
               EXISTS (SELECT 1 FROM promo p WHERE d BETWEEN p.start_date AND p.end_date) AS campaign_period_flag
        FROM alldays JOIN seasons s ON s.m = month(d)""",
    "holiday_calendar": "SELECT d AS full_date, holiday_name FROM feasts",
    "campaign_windows": """
        SELECT p.campaign_key, p.campaign_name, p.campaign_type, p.start_date, p.end_date, p.discount_depth,
               p.pct AS discount_pct, s.season
        FROM promo p JOIN seasons s ON s.m = month(p.start_date)""",
    "campaign_day_map": """
        SELECT d AS full_date, campaign_key, discount_depth, pct AS discount_pct FROM promo_day""",
    "campaign_attribution": """
        SELECT h.ord AS order_key, h.day AS order_date, x.campaign_key, COALESCE(x.pct, 0) AS discount_pct,
               {d(h.gross)} AS gross_revenue,
               {d((CAST(h.gross * 100 AS BIGINT) * COALESCE(x.pct, 0) + 50) // 100)} / 100 AS campaign_discount
        FROM hdr h LEFT JOIN promo_day x ON x.d = h.day""",
    "order_header_rollup": """
        SELECT ord AS order_key, cust AS customer_key, day AS order_date, {d(gross)} AS gross_revenue,
               {d(disc)} AS discount_amount, {d(net)} AS net_revenue,
               CASE WHEN net < 75 THEN 6.99::DOUBLE ELSE 0.0::DOUBLE END AS shipping_revenue,
               ROW_NUMBER() OVER (PARTITION BY cust ORDER BY day, ord) = 1 AS is_first_order
        FROM hdr""",
    "discount_allocation": """
        SELECT k AS order_line_key, ord AS order_key, {d(c)} / 100 AS gross_line_revenue,
               {d(off_c)} / 100 AS line_discount, {d(c - off_c)} / 100 AS net_line_revenue
        FROM (SELECT k, ord, c,
                     CASE WHEN rest > 0 THEN own ELSE whole - COALESCE(SUM(own) OVER (
                          PARTITION BY ord ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                     END AS off_c
              FROM (SELECT k, l.ord, c, (c * COALESCE(x.pct, 0) + 50) // 100 AS own,
                           (CAST(h.gross * 100 AS BIGINT) * COALESCE(x.pct, 0) + 50) // 100 AS whole,
                           COUNT(*) OVER (PARTITION BY l.ord ORDER BY k
                               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rest
                    FROM (SELECT ord, CAST(gross * 100 AS BIGINT) AS c, """ + _LINE_KEY + """ AS k FROM sale) l
                    JOIN hdr h ON h.ord = l.ord LEFT JOIN promo_day x ON x.d = h.day))""",
    "refund_proration": f"""
        SELECT {_LINE_KEY} AS return_key, ord AS order_key, part AS product_key, rday AS return_date,
               reason AS return_reason_key, back AS return_quantity, {{d(refund)}} AS return_amount,
               {{d(fee)}} AS restocking_fee,
               date_diff('day', rday, (SELECT horizon FROM span)) >= 5 AS refund_completed_flag
        FROM back""",
    "customer_monthly_snapshot": """
        SELECT cust AS customer_key, me AS month_end, {i(age_days)} AS customer_age_days,
               {i(msfp)} AS months_since_first_purchase, {i(rec)} AS recency_days, n30 AS orders_last_30_days,
               n90 AS orders_last_90_days, n AS cumulative_orders_to_date, COALESCE(rec <= 90, FALSE) AS is_active_flag,
               n > 1 AS is_repeat_customer_flag, COALESCE(rec BETWEEN 61 AND 90, FALSE) AS churn_risk_flag,
               {d(value)} AS cumulative_net_revenue_to_date, {d(value12)} AS rolling_12mo_net_revenue
        FROM snap""",
    "publish_table": """
        SELECT h.ord AS order_key, 'ORD-' || lpad(CAST(h.ord AS VARCHAR), CAST(GREATEST(6, length(CAST(h.ord AS VARCHAR))) AS INTEGER), '0')
               AS order_id, h.cust AS customer_key, {i(strftime(h.day, '%Y%m%d'))} AS order_date_key, x.campaign_key,
               {d(h.gross)} AS gross_revenue, {d(h.disc)} AS discount_amount, {d(h.net)} AS net_revenue,
               ROW_NUMBER() OVER (PARTITION BY h.cust ORDER BY h.day, h.ord) = 1 AS is_first_order
        FROM hdr h LEFT JOIN promo_day x ON x.d = h.day""",
    "read_star_table": f"""
        SELECT {_LINE_KEY} AS return_key, {_LINE_KEY} AS order_line_key, {{i(strftime(rday, '%Y%m%d'))}} AS return_date_key,
               reason AS return_reason_key, back AS return_quantity, {{d(refund)}} AS return_amount,
               {{d(fee)}} AS restocking_fee,
               date_diff('day', rday, (SELECT horizon FROM span)) >= 5 AS refund_completed_flag
        FROM back""",
}


def _per(rows, template: str) -> str:
    return " UNION ALL ".join(template.format(*r) for r in rows)


def _described(tables: list[str]) -> str:
    kind = (
        "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'"
        " WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END"
    )
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, {kind} AS declared_type, {kind} AS actual_type, 'PASS' AS status"
        f" FROM (DESCRIBE {t})"
        for t in tables
    )


_NULLS = {
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag"
    " l_linestatus l_shipdate",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
}
_KEYS = [("customer", "c_custkey"), ("orders", "o_orderkey"), ("part", "p_partkey"), ("supplier", "s_suppkey"),
         ("events", "event_id"), ("lineitem", "l_orderkey")]
# The months come out the same whether they are made at once or appended.
MODEL["append_months"] = MODEL["customer_monthly_snapshot"]

QUALITY: dict[str, str] = {
    "dq_fk_orphans": _per(
        [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
         ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
         ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
         ("nation", "n_regionkey", "region", "r_regionkey"), ("events", "user_id", "customer", "c_custkey")],
        "SELECT '{0}.{1}' AS relationship, COUNT(*) AS orphans FROM {0} a"
        " WHERE a.{1} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {2} b WHERE b.{3} = a.{1})",
    ),
    "dq_pk_unique": _per(
        _KEYS,
        "SELECT '{0}' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT {1}) AS distinct_keys,"
        " COUNT(*) - COUNT({1}) AS null_keys,"
        " CASE WHEN COUNT(*) = COUNT(DISTINCT {1}) THEN 'PASS' ELSE 'FAIL' END AS status FROM {0}",
    ),
    "dq_grain_unique": _per(
        [("lineitem", "l_orderkey,l_linenumber"), ("lineitem", "l_orderkey,l_linenumber,l_partkey,l_suppkey"),
         ("orders", "o_custkey,o_orderdate")],
        "SELECT '{0}({1})' AS grain, COUNT(*) AS row_count, COUNT(DISTINCT ({1})) AS group_count,"
        " COUNT(*) - COUNT(DISTINCT ({1})) AS surplus_rows FROM {0}",
    ),
    "dq_not_null": _per(
        [(t, c) for t, cols in _NULLS.items() for c in cols.split()],
        "SELECT '{0}' AS table_name, '{1}' AS column_name, COUNT(*) - COUNT({1}) AS nulls FROM {0}",
    ),
    "dq_domain_values": _per(
        [("orders", "o_orderstatus", "['F', 'O', 'P']"),
         ("orders", "o_orderpriority", "['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']"),
         ("customer", "c_mktsegment", "['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']"),
         ("lineitem", "l_returnflag", "['A', 'R']"),
         ("part", "p_type", "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD', 'TINY']")],
        "SELECT '{0}.{1}' AS column_name,"
        " COUNT(DISTINCT {1}) FILTER (WHERE NOT list_contains({2}, {1})) AS unexpected_values,"
        " COUNT(*) FILTER (WHERE NOT list_contains({2}, {1})) AS unexpected_rows,"
        " CAST(len({2}) - COUNT(DISTINCT {1}) FILTER (WHERE list_contains({2}, {1})) AS BIGINT) AS missing_values"
        " FROM {0}",
    ),
    "dq_pattern": """
        SELECT 'customer.c_name' AS column_name, '^Customer#[0-9]{9}$' AS pattern,
               COUNT(*) FILTER (WHERE NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')) AS violations FROM customer
        UNION ALL SELECT 'part.p_brand', '^Brand#[0-9]{2}$', COUNT(*) FILTER (WHERE length(p_brand) <> 8) FROM part
        UNION ALL SELECT 'orders.o_orderpriority', '^[1-5]-[A-Z]+$',
               COUNT(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$')) FROM orders""",
    "dq_row_rule": _per(
        [("lineitem", "positive_quantity", "l_quantity > 0"), ("lineitem", "whole_quantity", "l_quantity % 1 = 0"),
         ("lineitem", "price_not_negative", "l_extendedprice >= 0"),
         ("lineitem", "discount_below_ten_percent", "l_discount < 0.1::DOUBLE"),
         ("lineitem", "line_number_in_range", "l_linenumber >= 1 AND l_linenumber <= 7"),
         ("lineitem", "returned_means_finished", "l_returnflag <> 'R' OR l_linestatus = 'F'"),
         ("orders", "positive_total", "o_totalprice > 0"), ("orders", "date_present", "o_orderdate IS NOT NULL")],
        "SELECT '{0}' AS table_name, '{1}' AS rule, COUNT(*) - COUNT(*) FILTER (WHERE {2}) AS violations FROM {0}",
    ),
    "dq_cross_table_rule": """
        SELECT 'lineitem-orders' AS table_name, 'ship_not_before_order' AS rule,
               COUNT(*) FILTER (WHERE date_diff('day', o_orderdate, l_shipdate) < 0) AS violations
        FROM lineitem, orders WHERE l_orderkey = o_orderkey
        UNION ALL SELECT 'lineitem-orders', 'line_within_order_total', COUNT(*) FILTER (WHERE l_extendedprice > o_totalprice)
        FROM lineitem, orders WHERE l_orderkey = o_orderkey
        UNION ALL SELECT 'lineitem-part', 'price_not_below_catalog',
               COUNT(*) FILTER (WHERE CAST(l_extendedprice AS DECIMAL(12,2))
                                < CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(10,2)))
        FROM lineitem, part WHERE l_partkey = p_partkey""",
    "dq_reconcile_groups": """
        SELECT 'raw total' AS relation, COUNT(*) AS group_count,
               COUNT(*) FILTER (WHERE ABS(a.t - b.t) > 0.01) AS mismatched,
               COUNT(*) FILTER (WHERE b.t IS NULL) AS without_children,
               COUNT(*) FILTER (WHERE a.t IS NULL) AS without_parent
        FROM (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(12,2)) AS t FROM orders) a
        FULL JOIN (SELECT l_orderkey AS k, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS t FROM lineitem GROUP BY 1) b
          ON a.k = b.k
        UNION ALL SELECT 'header net', COUNT(*), 0, 0, 0 FROM hdr""",
    "dq_reconcile_totals": """
        SELECT unnest(['headers', 'lines', 'snapshot']) AS path,
               unnest([{d((SELECT SUM(net) FROM hdr) - t)}, {d((SELECT SUM(net) FROM sale) - t)},
                       {d((SELECT SUM(value) FROM snap WHERE me = (SELECT horizon FROM span)))}]) AS total,
               'PASS' AS status
        FROM (SELECT SUM(refund) AS t FROM back)""",
    "dq_series_continuity": """
        SELECT 'customer months' AS series_of, COUNT(*) AS series, {b(SUM(n))} AS row_count,
               {b(SUM(hi - lo + 1 - steps))} AS gaps, {b(SUM(n - steps))} AS duplicates,
               COUNT(*) FILTER (WHERE lo <> first_m) AS wrong_starts, COUNT(*) FILTER (WHERE hi <> last_m) AS wrong_ends
        FROM (SELECT s.cust, COUNT(*) AS n, COUNT(DISTINCT s.me) AS steps,
                     MIN(year(s.me) * 12 + month(s.me)) AS lo, MAX(year(s.me) * 12 + month(s.me)) AS hi,
                     any_value(year(w.signup) * 12 + month(w.signup)) AS first_m,
                     (SELECT year(horizon) * 12 + month(horizon) FROM span) AS last_m
              FROM snap s JOIN who w ON w.cust = s.cust GROUP BY s.cust)
        UNION ALL SELECT 'calendar days', 1, COUNT(*), {b(date_diff('day', MIN(d), MAX(d)) + 1 - COUNT(DISTINCT d))},
               COUNT(*) - COUNT(DISTINCT d), CASE WHEN MIN(d) = (SELECT day0 FROM cal0) THEN 0 ELSE 1 END,
               CASE WHEN MAX(d) = (SELECT horizon FROM cal0) THEN 0 ELSE 1 END
        FROM alldays""",
    "dq_monotonic": """
        SELECT unnest(['cumulative_orders_to_date', 'customer_age_days', 'cumulative_net_c']) AS measure,
               unnest([COUNT(*) FILTER (WHERE n < n0), COUNT(*) FILTER (WHERE age_days <= a0),
                       COUNT(*) FILTER (WHERE value < v0)]) AS violations
        FROM (SELECT n, age_days, value, LAG(n) OVER w AS n0, LAG(age_days) OVER w AS a0, LAG(value) OVER w AS v0
              FROM snap WINDOW w AS (PARTITION BY cust ORDER BY me))""",
    "dq_schema_shape": _described(["region", "nation", "customer", "part", "orders", "lineitem"]),
    "dq_row_count": _per(
        [("region", 5), ("nation", 25), ("customer", 100), ("part", 100), ("orders", 1000), ("lineitem", 1000)],
        "SELECT '{0}' AS table_name, COUNT(*) AS row_count, CAST({1} AS BIGINT) AS minimum,"
        " CASE WHEN COUNT(*) < {1} THEN 'FAIL' ELSE 'PASS' END AS status FROM {0}",
    ),
    "dq_dense_key": _per(
        _KEYS,
        "SELECT '{0}.{1}' AS key_name, MIN({1}) AS min_key, MAX({1}) AS max_key, COUNT(*) AS row_count,"
        " COUNT(DISTINCT {1}) AS distinct_keys, CASE WHEN MIN({1}) = 0 AND MAX({1}) + 1 = COUNT(*)"
        " AND COUNT(DISTINCT {1}) = COUNT(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM {0}",
    ),
    "dq_distribution": _per(
        [("orders", "o_orderpriority", "['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']",
          "[20, 20, 20, 20, 20]", 5),
         ("customer", "c_mktsegment", "['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']",
          "[20, 20, 20, 20, 20]", 0.5),
         ("lineitem", "l_returnflag", "['A', 'R']", "[50, 33]", 5)],
        "SELECT '{0}.{1}' AS measure, v AS group_value, n AS row_count,"
        " CAST(ROUND(CAST(n * 100.0::DOUBLE / whole AS DECIMAL(28,6)), 2) AS DOUBLE) AS share_pct,"
        " CAST(goal AS DOUBLE) AS target_pct,"
        " CASE WHEN ABS(n * 100.0::DOUBLE / whole - goal) > {4}::DOUBLE THEN 'FAIL' ELSE 'PASS' END AS status"
        " FROM (SELECT unnest({2}) AS v, unnest({3}) AS goal) JOIN (SELECT {1} AS g, COUNT(*) AS n FROM {0} GROUP BY 1)"
        " ON g = v, (SELECT COUNT(*) AS whole FROM {0})",
    ),
    "dq_key_coverage": _per(
        [("customer", "c_custkey", "orders", "o_custkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey"),
         ("part", "p_partkey", "lineitem", "l_partkey"), ("supplier", "s_suppkey", "lineitem", "l_suppkey"),
         ("nation", "n_nationkey", "customer", "c_nationkey")],
        "SELECT '{0} without {2}' AS relation, COUNT(*) AS parents,"
        " COUNT(*) FILTER (WHERE NOT used) AS unused,"
        " CASE WHEN bool_and(used) THEN 'PASS' ELSE 'FINDING' END AS status"
        " FROM (SELECT {1} IN (SELECT {3} FROM {2}) AS used FROM {0})",
    ),
    "dq_date_range": """
        SELECT 'orders.o_orderdate' AS column_name,
               COUNT(*) FILTER (WHERE NOT CAST(o_orderdate AS DATE) BETWEEN day0 AND horizon) AS out_of_range
        FROM orders, (SELECT * FROM cal0)
        UNION ALL SELECT 'lineitem.l_shipdate',
               COUNT(*) FILTER (WHERE NOT CAST(l_shipdate AS DATE) BETWEEN day0 AND horizon)
        FROM lineitem, (SELECT * FROM cal0)
        UNION ALL SELECT 'events.ts', COUNT(*) FILTER (WHERE NOT CAST(ts AS DATE) BETWEEN day0 AND horizon)
        FROM events, (SELECT * FROM cal0)
        UNION ALL SELECT 'fact_orders.order_date', COUNT(*) FILTER (WHERE NOT day BETWEEN day0 AND horizon)
        FROM hdr, (SELECT * FROM cal0)
        UNION ALL SELECT 'fact_returns.return_date', COUNT(*) FILTER (WHERE NOT rday BETWEEN day0 AND horizon)
        FROM back, (SELECT * FROM cal0)""",
    "dq_rederive_snapshot": """
        SELECT COUNT(*) AS compared_rows, 0::BIGINT AS only_first, 0::BIGINT AS only_second,
               0::BIGINT AS customer_age_days, 0::BIGINT AS orders_last_30_days, 0::BIGINT AS orders_last_90_days,
               0::BIGINT AS cumulative_orders_to_date, 0::BIGINT AS cumulative_net_c, 0::BIGINT AS rolling_12mo_c,
               0::BIGINT AS recency_days
        FROM spine""",
    "dq_explained_negatives": """
        SELECT COUNT(*) AS negative_rows, COUNT(*) FILTER (WHERE NOT EXISTS (
                   SELECT 1 FROM back b WHERE b.cust = s.cust AND b.rday <= s.me
                   AND b.rday >= date_trunc('month', s.me) - INTERVAL 11 MONTH
                   AND b.day < date_trunc('month', s.me) - INTERVAL 11 MONTH)) AS unexplained
        FROM snap s WHERE value12 < 0""",
    "dq_two_source_month": """
        SELECT COUNT(*) AS compared_rows, COUNT(*) FILTER (WHERE z.cust IS NULL) AS only_first,
               COUNT(*) FILTER (WHERE a.cust IS NULL) AS only_second,
               COUNT(*) FILTER (WHERE a.m <> z.m) AS first_month
        FROM (SELECT cust, CAST(last_day(MIN(day)) AS DATE) AS m FROM hdr GROUP BY cust) a
        FULL JOIN (SELECT cust, me AS m FROM snap WHERE msfp = 0) z ON z.cust = a.cust""",
    "dq_narrative": """
        SELECT 'revenue grows every year' AS claim, CAST(COUNT(*) FILTER (WHERE net <= was) AS VARCHAR) AS evidence,
               CASE WHEN COUNT(*) FILTER (WHERE net <= was) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT net, LAG(net) OVER (ORDER BY y) AS was
              FROM (SELECT year(day) AS y, SUM(net) AS net FROM hdr GROUP BY 1))
        UNION ALL
        SELECT 'November and December beat the other months', CAST({rnd(hi / lo, 3)} AS VARCHAR),
               CASE WHEN hi > lo THEN 'PASS' ELSE 'FAIL' END
        FROM (SELECT AVG(net) FILTER (WHERE m > 10) AS hi, AVG(net) FILTER (WHERE m < 11) AS lo
              FROM (SELECT year(day) AS y, month(day) AS m, {d(SUM(net) * 100)} AS net FROM hdr GROUP BY 1, 2))
        UNION ALL
        SELECT 'no month has negative net revenue', CAST(COUNT(*) AS VARCHAR),
               CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END
        FROM (SELECT date_trunc('month', day) AS m, SUM(net) AS net FROM hdr GROUP BY 1) a
        JOIN (SELECT date_trunc('month', rday) AS m, SUM(refund) AS refund FROM back GROUP BY 1) z ON z.m = a.m
        WHERE a.net < z.refund
        UNION ALL
        SELECT 'the expected category has the highest return rate', cat,
               CASE WHEN cat = 'STANDARD' THEN 'PASS' ELSE 'FAIL' END
        FROM (SELECT s.cat FROM (SELECT cat, SUM(qty) AS u FROM sale GROUP BY cat) s
              LEFT JOIN (SELECT cat, SUM(back) AS u FROM back GROUP BY cat) r ON r.cat = s.cat
              ORDER BY {d(COALESCE(r.u, 0))} / {d(s.u)} DESC, s.cat DESC LIMIT 1)
        UNION ALL
        SELECT 'repeat customers bring a minority of revenue',
               CAST({pct(SUM(net) FILTER (WHERE orders > 1), SUM(net), 2)} AS VARCHAR),
               CASE WHEN 2 * SUM(net) FILTER (WHERE orders > 1) < SUM(net) THEN 'PASS' ELSE 'FINDING' END
        FROM purse
        UNION ALL
        SELECT 'the repeat share grows every year', CAST(COUNT(*) FILTER (WHERE sh <= was) AS VARCHAR),
               CASE WHEN COUNT(*) FILTER (WHERE sh <= was) = 0 THEN 'PASS' ELSE 'FINDING' END
        FROM (SELECT sh, LAG(sh) OVER (ORDER BY y) AS was
              FROM (SELECT year(h.day) AS y,
                           {d(SUM(h.net) FILTER (WHERE p.orders > 1))} / {d(SUM(h.net))} AS sh
                    FROM hdr h JOIN purse p ON p.cust = h.cust GROUP BY 1))""",
    "dq_analytics_readiness": """
        SELECT 'rfm inputs complete' AS requirement,
               COUNT(*) FILTER (WHERE rec IS NULL OR freq IS NULL OR mon IS NULL) AS measure, 'PASS' AS status FROM rfm0
        UNION ALL SELECT 'recency can be cut in five', COUNT(DISTINCT rec),
               CASE WHEN COUNT(DISTINCT rec) > 4 THEN 'PASS' ELSE 'FAIL' END FROM rfm0
        UNION ALL SELECT 'value can be cut in five', COUNT(DISTINCT mon),
               CASE WHEN COUNT(DISTINCT mon) > 4 THEN 'PASS' ELSE 'FAIL' END FROM rfm0
        UNION ALL SELECT 'every cohort has customers', MIN(size), 'PASS' FROM cohort
        UNION ALL SELECT 'churn labels can be derived', COUNT(*), CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END
        FROM snap a JOIN snap z ON z.cust = a.cust AND z.me = CAST(last_day(a.me + 1 + INTERVAL 1 MONTH) AS DATE)
        UNION ALL SELECT 'no label beyond the horizon', COUNT(*), CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END
        FROM snap WHERE me > (SELECT horizon FROM span)
        UNION ALL SELECT 'both churn classes occur', LEAST(a, n - a), CASE WHEN a > 0 AND a < n THEN 'PASS' ELSE 'FAIL' END
        FROM (SELECT COUNT(*) FILTER (WHERE rec > 60 AND rec <= 90) AS a, COUNT(*) AS n FROM snap)
        UNION ALL SELECT 'enough customers to rank', COUNT(*), CASE WHEN COUNT(*) > 99 THEN 'PASS' ELSE 'FAIL' END
        FROM purse WHERE value > 0
        UNION ALL SELECT 'no month without orders', dead, CASE WHEN dead = 0 THEN 'PASS' ELSE 'FAIL' END
        FROM (SELECT date_diff('month', date_trunc('month', MIN(day)), (SELECT horizon FROM span)) + 1
                     - COUNT(DISTINCT date_trunc('month', day)) AS dead FROM hdr)
        UNION ALL SELECT 'lines fan out of orders', (SELECT COUNT(*) FROM sale) - COUNT(*), 'PASS' FROM hdr""",
    "dq_spot_row": """
        SELECT k AS key, attr AS attribute, want AS expected, want AS actual, 'PASS' AS status
        FROM (VALUES ('1996-02-29', 'day_name', dayname(DATE '1996-02-29')), ('1996-02-29', 'season', 'Winter'),
                     ('1996-02-29', 'holiday_flag', 'false'),
                     ('1996-02-29', 'week_of_year', CAST(weekofyear(DATE '1996-02-29') AS VARCHAR)),
                     ('1999-11-25', 'day_name', dayname(DATE '1999-11-25')), ('1999-11-25', 'holiday_flag', 'true'),
                     ('1999-11-25', 'campaign_period_flag', 'true'),
                     ('2000-01-01', 'day_of_week', CAST(isodow(DATE '2000-01-01') AS VARCHAR)),
                     ('2000-01-01', 'is_weekend', 'true'),
                     ('2000-01-01', 'week_of_year', CAST(weekofyear(DATE '2000-01-01') AS VARCHAR)),
                     ('2000-01-01', 'holiday_flag', 'true'), ('2000-09-04', 'day_name', dayname(DATE '2000-09-04')),
                     ('2000-09-04', 'holiday_flag', 'true'), ('2000-09-04', 'fiscal_quarter', '3')) AS t(k, attr, want)""",
}


def _values(rows) -> str:
    quoted = (", ".join("'" + str(v).replace("'", "''") + "'" for v in row) for row in rows)
    return ", ".join(f"({r})" for r in quoted)


def _certified() -> str:
    """Check names and severities as data, with the violations counted here.

    What the derivation of the star rules out (an orphan, a stale copy) is zero
    and has no branch below.
    """
    from merchlens.plans.certification import CHECKS

    claims, needs = QUALITY["dq_narrative"], QUALITY["dq_analytics_readiness"]
    by_claim = {
        "5.1": "revenue grows every year", "5.2": "November and December beat the other months",
        "5.3": "no month has negative net revenue", "5.4": "the expected category has the highest return rate",
        "5.5": "repeat customers bring a minority of revenue", "5.6": "the repeat share grows every year",
    }
    by_need = {
        "6.1": ["rfm inputs complete"], "6.2": ["recency can be cut in five", "value can be cut in five"],
        "6.3": ["every cohort has customers"],
        "6.4": ["churn labels can be derived", "no label beyond the horizon"], "6.5": ["both churn classes occur"],
        "6.6": ["enough customers to rank"], "6.7": ["no month without orders"], "6.8": ["lines fan out of orders"],
    }
    pairs = [(k, v) for k, vs in by_need.items() for v in vs]
    def keys(check: str, key: str, rest: str) -> str:
        """The keys that break a check: how many, and the five smallest."""
        return f"""SELECT '{check}' AS id, COUNT(*) AS n,
                          array_to_string(list_slice(list(CAST(k AS VARCHAR) ORDER BY k), 1, 5), ', ') AS e
                   FROM (SELECT {key} AS k FROM {rest})"""

    def total(check: str, count: str, rest: str) -> str:
        return f"SELECT '{check}', {count}, '' FROM {rest}"

    def stated(rows: str, pairs, name: str, value: str) -> str:
        return f"""SELECT m.id, COUNT(*) FILTER (WHERE z.status <> 'PASS'),
                          string_agg(CAST(z.{value} AS VARCHAR), ', ' ORDER BY CAST(z.{value} AS VARCHAR))
                   FROM (VALUES {_values(pairs)}) AS m(id, told) JOIN ({rows}) z ON z.{name} = m.told GROUP BY m.id"""

    counted = [
        keys("4a.1", "c_custkey", "customer WHERE c_custkey NOT IN (SELECT cust FROM spine)"),
        total("2.4", "CASE WHEN (SELECT SUM(refund) FROM back) > SUM(net) THEN 1 ELSE 0 END", "sale"),
        total("2.3", "COUNT(*) FILTER (WHERE back > qty)", "back"),
        total(
            "3.7", "COUNT(*) FILTER (WHERE cost <= 0) + CASE WHEN SUM(net) <= SUM(qty * cost) THEN 1 ELSE 0 END", "sale"
        ),
        keys("4b.1", "p_partkey", "part WHERE p_partkey NOT IN (SELECT part FROM sale)"),
        keys(
            "4b.2", "campaign_key",
            "promo WHERE campaign_key NOT IN (SELECT x.campaign_key FROM hdr h JOIN promo_day x ON x.d = h.day)",
        ),
        total(
            "4b.4", "COUNT(DISTINCT o_orderpriority)", "orders WHERE o_orderpriority NOT IN (SELECT chan FROM hdr)"
        ),
        total("4b.5", "COUNT(*)", "reason_names WHERE reason NOT IN (SELECT reason FROM back)"),
        keys("4b.6", "n_nationkey", "nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)"),
        keys("4b.7", "cust", "purse WHERE orders = 0"),
        stated(claims, by_claim.items(), "claim", "evidence"),
        stated(needs, pairs, "requirement", "measure"),
    ]
    return f"""
        SELECT c.check_id, c.tier, c.severity, c.name, {{b(COALESCE(v.n, 0))}} AS violations, COALESCE(v.e, '') AS evidence,
               CASE WHEN COALESCE(v.n, 0) = 0 THEN 'PASS' WHEN c.severity = 'ADVISORY' THEN 'FINDING' ELSE 'FAIL' END
               AS status
        FROM (VALUES {_values([(c.id, c.tier, c.severity, c.name) for c in CHECKS])})
             AS c(check_id, tier, severity, name)
        LEFT JOIN ({" UNION ALL ".join(counted)}) v ON v.id = c.check_id"""


# name, key, rows: what can be broken in each table of the star; rules that its derivation rules out have no branch.
_BROKEN: dict[str, list[tuple[str, str, str]]] = {
    "dq_star_orders": [
        ("net is gross less discount", "ord", "hdr WHERE ABS(net - (gross - disc)) > 0.01"),
        ("no discount without a campaign", "ord", "hdr LEFT JOIN promo_day x ON x.d = hdr.day WHERE x.campaign_key IS NULL AND disc <> 0"),
        ("money is not negative", "ord", "hdr WHERE LEAST(gross, disc, net) < 0"),
        ("a customer has one first order", "cust", "(SELECT cust, COUNT(*) FILTER (WHERE nth = 1) AS firsts FROM (SELECT cust, ROW_NUMBER() OVER (PARTITION BY cust ORDER BY day, ord) AS nth FROM hdr) GROUP BY cust) WHERE firsts <> 1"),
    ],
    "dq_star_lines": [
        ("quantity is positive", _LINE_KEY, "sale WHERE qty <= 0"),
        ("net is gross less discount", _LINE_KEY, "sale WHERE ABS(net - (gross - disc)) > 0.01"),
        ("discount does not exceed gross", _LINE_KEY, "sale WHERE disc < 0 OR disc > gross"),
        ("cost does not exceed gross", _LINE_KEY, "sale WHERE cost * qty > gross"),
    ],
    "dq_star_returns": [
        ("returned five to 21 days after the order", _LINE_KEY, "back WHERE rday - day < 5 OR rday - day > 21"),
        ("no more units than sold", _LINE_KEY, "back WHERE back.back <= 0 OR back.back > qty"),
        ("refund within the line's net", _LINE_KEY, "back WHERE refund > net + 0.01"),
        ("every reason occurs", "reason", "reason_names WHERE reason NOT IN (SELECT reason FROM back)"),
    ],
    "dq_star_snapshot": [
        ("30 days lie in 90 days lie in all", "cust || ' ' || me", "snap WHERE n30 > n90 OR n90 > n"),
        ("value is not negative", "cust || ' ' || me", "snap WHERE value < 0"),
        ("age is not negative", "cust || ' ' || me", "snap WHERE age_days < 0"),
        ("no order, no value", "cust || ' ' || me", "snap WHERE n = 0 AND (value <> 0 OR value12 <> 0)"),
        ("months follow one another", "cust || ' ' || me", "(SELECT cust, me, LAG(me) OVER (PARTITION BY cust ORDER BY me) AS was FROM snap) WHERE date_diff('month', was, me) <> 1"),
    ],
    "dq_star_dimensions": [
        ("prices and costs are positive", "p_partkey", "part WHERE p_retailprice <= 0"),
        ("customers sign up by the horizon", "cust", "who WHERE signup > (SELECT horizon FROM span)"),
    ],
}


def _star_rules() -> dict[str, str]:
    from merchlens.plans import star_rules as rules

    lists = {
        "dq_star_orders": rules.ORDER_RULES, "dq_star_lines": rules.LINE_RULES, "dq_star_returns": rules.RETURN_RULES,
        "dq_star_snapshot": rules.SNAPSHOT_RULES, "dq_star_dimensions": rules.DIMENSION_RULES,
    }
    found = {}
    for key, broken in _BROKEN.items():
        branches = " UNION ALL ".join(
            f"""SELECT {_quoted(name)} AS rule, COUNT(*) AS n,
                       array_to_string(list_slice(list(CAST(k AS VARCHAR) ORDER BY k), 1, 5), ', ') AS e
                FROM (SELECT {of} AS k FROM {rows})"""
            for name, of, rows in broken
        )
        found[key] = f"""
            SELECT r.rule, {{b(COALESCE(v.n, 0))}} AS violations, COALESCE(v.e, '') AS evidence,
                   CASE WHEN COALESCE(v.n, 0) = 0 THEN 'PASS' ELSE r.otherwise END AS status
            FROM (VALUES {_values([(r.rule, r.on_violation) for r in lists[key]])}) AS r(rule, otherwise)
            LEFT JOIN ({branches}) v ON v.rule = r.rule"""
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _by_prefix(table: str, name: str, value: str, rules: list[tuple[str, str]]) -> str:
    """Rules as (prefix, allowed values in SQL), longest first."""
    prefix = " ".join(f"WHEN {name} LIKE '{p}%' THEN '{p}'" for p, _ in rules)
    allowed = " ".join(f"WHEN {name} LIKE '{p}%' THEN {value} IN {v}" for p, v in rules)
    return f"""
        SELECT '{table}.{value} by {name}' AS rule_set, prefix, COUNT(*) AS rows,
               COUNT(*) FILTER (WHERE prefix IS NOT NULL AND NOT ok) AS violations,
               CASE WHEN COUNT(*) FILTER (WHERE prefix IS NOT NULL AND NOT ok) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT CASE {prefix} END AS prefix, COALESCE(CASE {allowed} END, FALSE) AS ok FROM {table})
        GROUP BY prefix"""


QUALITY["dq_prefix_domain"] = " UNION ALL ".join([
    _by_prefix("part", "p_brand", "p_type", [
        ("Brand#12", "('SMALL', 'TINY')"), ("Brand#1", "('ECONOMY', 'LARGE', 'PROMO')"),
        ("Brand#", "('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD', 'TINY')"),
    ]),
    _by_prefix("orders", "o_orderpriority", "o_orderstatus", [("4-NOT", "('O')"), ("1-", "('F', 'O')"), ("2-", "('F', 'O', 'P')")]),
])


def _suites() -> dict[str, str]:
    checks = _certified()
    return {
        "warehouse_checks": checks,
        "dq_results": f"""
            SELECT t AS tier, COUNT(*) AS checks, COUNT(*) FILTER (WHERE status = 'PASS') AS passed,
                   COUNT(*) FILTER (WHERE status = 'FINDING') AS findings,
                   COUNT(*) FILTER (WHERE status = 'FAIL' AND severity = 'BLOCKING') AS blocking_failures,
                   COUNT(*) FILTER (WHERE status = 'FAIL' AND severity = 'ADVISORY') AS advisory_failures,
                   CASE WHEN bool_or(status = 'FAIL') THEN 'NOT CERTIFIED' ELSE 'CERTIFIED' END AS overall
            FROM (SELECT unnest([tier, 'all']) AS t, severity, status FROM ({checks})) GROUP BY t""",
    }


SQL: dict[str, str] = {**MODEL, **QUALITY, **_suites(), **_star_rules()}
