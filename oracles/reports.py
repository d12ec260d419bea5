"""The report modules in SQL."""

SQL: dict[str, str] = {
    # -- executive -------------------------------------------------------------
    "kpi_order_net_revenue": "SELECT {d(SUM(net))} AS order_net_revenue FROM hdr",
    "kpi_net_revenue": """
        SELECT {d((SELECT SUM(net) FROM hdr) - (SELECT COALESCE(SUM(refund), 0) FROM back))} AS net_revenue""",
    "kpi_gross_margin_pct": """
        SELECT {pct(SUM(net) - SUM(qty * cost), SUM(net), 2)} AS gross_margin_pct FROM sale""",
    "kpi_aov": "SELECT {avg(SUM(net), COUNT(*), 2)} AS avg_order_value FROM hdr",
    "kpi_discount_impact_pct": "SELECT {pct(SUM(disc), SUM(gross), 2)} AS discount_impact_pct FROM hdr",
    "kpi_return_rate_pct": """
        SELECT {pct((SELECT SUM(back) FROM back), (SELECT SUM(qty) FROM sale), 2)} AS return_rate_pct""",
    "kpi_repeat_purchase_rate_pct": """
        SELECT {pct(COUNT(*) FILTER (WHERE orders > 1), COUNT(*), 2)} AS repeat_purchase_rate_pct FROM purse""",
    "kpi_panel": """
        SELECT {d(h.net)} AS order_net_revenue, {d(h.net - b.refund)} AS net_revenue,
               {pct(s.net - s.cogs, s.net, 2)} AS gross_margin_pct, {avg(h.net, h.n, 2)} AS avg_order_value,
               {pct(h.disc, h.gross, 2)} AS discount_impact_pct, {pct(b.units, s.units, 2)} AS return_rate_pct,
               {pct(c.again, c.n, 2)} AS repeat_purchase_rate_pct, h.n AS total_orders, c.n AS total_customers
        FROM (SELECT SUM(net) AS net, SUM(disc) AS disc, SUM(gross) AS gross, COUNT(*) AS n FROM hdr) h,
             (SELECT SUM(net) AS net, SUM(qty * cost) AS cogs, SUM(qty) AS units FROM sale) s,
             (SELECT SUM(refund) AS refund, SUM(back) AS units FROM back) b,
             (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE orders > 1) AS again FROM purse) c""",
    # -- revenue ---------------------------------------------------------------
    "revenue_by_year": """
        SELECT {i(year(day))} AS year, COUNT(*) AS orders, {d(SUM(net))} AS order_net_revenue,
               {pct(SUM(net), (SELECT SUM(net) FROM hdr), 2)} AS pct_of_total
        FROM hdr GROUP BY year(day)""",
    "revenue_by_quarter": """
        SELECT {i(year(day))} AS year, {i(quarter(day))} AS quarter, COUNT(*) AS orders,
               {d(SUM(net))} AS order_net_revenue
        FROM hdr GROUP BY year(day), quarter(day)""",
    "revenue_by_month": """
        SELECT {i(year(day))} AS year, {i(month(day))} AS month, COUNT(*) AS orders,
               {d(SUM(net))} AS order_net_revenue
        FROM hdr GROUP BY year(day), month(day)""",
    "revenue_yoy_annual": """
        SELECT {i(y)} AS year, {d(net)} AS order_net_revenue, {d(was)} AS prior_year,
               {pct(net - was, was, 1)} AS yoy_growth_pct
        FROM (SELECT y, net, LAG(net) OVER (ORDER BY y) AS was
              FROM (SELECT year(day) AS y, SUM(net) AS net FROM hdr GROUP BY 1))""",
    "revenue_yoy_quarter": """
        SELECT {i(y)} AS year, {i(q)} AS quarter, {d(net)} AS order_net_revenue,
               {pct(net - was, was, 1)} AS yoy_same_quarter_pct
        FROM (SELECT y, q, net, LAG(net) OVER (PARTITION BY q ORDER BY y) AS was
              FROM (SELECT year(day) AS y, quarter(day) AS q, SUM(net) AS net FROM hdr GROUP BY 1, 2))""",
    "revenue_yoy_month": """
        SELECT {i(y)} AS year, {i(q)} AS month, {d(net)} AS order_net_revenue,
               {pct(net - was, was, 1)} AS yoy_same_month_pct
        FROM (SELECT y, q, net, LAG(net) OVER (PARTITION BY q ORDER BY y) AS was
              FROM (SELECT year(day) AS y, month(day) AS q, SUM(net) AS net FROM hdr GROUP BY 1, 2))""",
    "revenue_by_sales_channel": """
        SELECT chan AS channel_name, COUNT(*) AS orders, {d(SUM(net))} AS order_net_revenue,
               {avg(SUM(net), COUNT(*), 2)} AS aov, {pct(SUM(net), (SELECT SUM(net) FROM hdr), 1)} AS pct_of_revenue
        FROM hdr GROUP BY chan""",
    "revenue_by_category": """
        SELECT cat AS category, {d(SUM(net))} AS order_net_revenue,
               {pct(SUM(net), (SELECT SUM(net) FROM sale), 1)} AS pct_of_revenue, {b(SUM(qty))} AS units_sold
        FROM sale GROUP BY cat""",
    "revenue_category_year": """
        SELECT cat AS category, {i(year(day))} AS year, {d(SUM(net))} AS order_net_revenue
        FROM sale GROUP BY cat, year(day)""",
    "revenue_category_concentration": """
        SELECT category, {d(net)} AS order_net_revenue, {pct(net, SUM(net) OVER (), 1)} AS pct_of_revenue,
               {pct(SUM(net) OVER (ORDER BY net DESC), SUM(net) OVER (), 1)} AS cumulative_pct,
               ROW_NUMBER() OVER (ORDER BY net DESC, category) AS revenue_rank
        FROM (SELECT cat AS category, SUM(net) AS net FROM sale GROUP BY cat)""",
    "variance_by_channel": """
        SELECT chan AS channel_name, {d(a)} AS rev_base_year, {d(z)} AS rev_next_year, {d(z - a)} AS yoy_change,
               {pct(z - a, SUM(z - a) OVER (), 1)} AS pct_of_total_change
        FROM (SELECT chan, COALESCE(SUM(net) FILTER (WHERE year(day) = 1999), 0) AS a,
                     COALESCE(SUM(net) FILTER (WHERE year(day) = 2000), 0) AS z
              FROM hdr WHERE year(day) BETWEEN 1999 AND 2000 GROUP BY chan)""",
    "variance_by_category": """
        SELECT cat AS category, {d(a)} AS rev_base_year, {d(z)} AS rev_next_year, {d(z - a)} AS yoy_change,
               {pct(z - a, SUM(z - a) OVER (), 1)} AS pct_of_total_change
        FROM (SELECT cat, COALESCE(SUM(net) FILTER (WHERE year(day) = 1999), 0) AS a,
                     COALESCE(SUM(net) FILTER (WHERE year(day) = 2000), 0) AS z
              FROM sale WHERE year(day) BETWEEN 1999 AND 2000 GROUP BY cat)""",
    "revenue_path_reconciliation": """
        SELECT path, {d(net)} AS order_net_revenue,
               CASE WHEN net = (SELECT SUM(net) FROM hdr) THEN 'PASS' ELSE 'FAIL' END AS regression_result
        FROM (SELECT unnest(['header_total', 'header_by_year', 'header_by_channel']) AS path, SUM(net) AS net FROM hdr
              UNION ALL SELECT 'line_by_category', SUM(net) FROM sale)""",
    # -- product ---------------------------------------------------------------
    "category_profitability": """
        SELECT cat AS category, {d(net)} AS revenue, {d(cogs)} AS cogs, {d(net - cogs)} AS gross_profit,
               {pct(net - cogs, net, 1)} AS gross_margin_pct,
               {pct(net - cogs, SUM(net - cogs) OVER (), 1)} AS profit_contribution_pct
        FROM (SELECT cat, SUM(net) AS net, SUM(qty * cost) AS cogs FROM sale GROUP BY cat)""",
    "top_products_by_profit": """
        SELECT part AS product_key, any_value(pname) AS product_name, any_value(cat) AS category,
               {b(SUM(qty))} AS units_sold, {d(SUM(net))} AS revenue, {d(SUM(net) - SUM(qty * cost))} AS gross_profit,
               {pct(SUM(net) - SUM(qty * cost), SUM(net), 1)} AS margin_pct
        FROM sale GROUP BY part ORDER BY SUM(net) - SUM(qty * cost) DESC, part LIMIT 15""",
    "bottom_products_by_profit": """
        SELECT part AS product_key, any_value(pname) AS product_name, any_value(cat) AS category,
               {b(SUM(qty))} AS units_sold, {d(SUM(net))} AS revenue, {d(SUM(net) - SUM(qty * cost))} AS gross_profit,
               {pct(SUM(net) - SUM(qty * cost), SUM(net), 1)} AS margin_pct
        FROM sale GROUP BY part ORDER BY SUM(net) - SUM(qty * cost), part LIMIT 15""",
    "category_return_performance": """
        SELECT s.cat AS category, {b(s.units)} AS units_sold, {b(COALESCE(r.units, 0))} AS units_returned,
               {pct(COALESCE(r.units, 0), s.units, 1)} AS return_rate_pct,
               {d(COALESCE(r.refund, 0))} AS revenue_returned,
               {pct(COALESCE(r.refund, 0), s.net, 1)} AS pct_revenue_returned
        FROM (SELECT cat, SUM(qty) AS units, SUM(net) AS net FROM sale GROUP BY cat) s
        LEFT JOIN (SELECT cat, SUM(back) AS units, SUM(refund) AS refund FROM back GROUP BY cat) r ON r.cat = s.cat""",
    "category_value_divergence": """
        SELECT category, {d(net)} AS revenue, RANK() OVER (ORDER BY net DESC) AS revenue_rank,
               {d(gp)} AS gross_profit, RANK() OVER (ORDER BY gp DESC) AS profit_rank,
               {pct(gp, net, 1)} AS margin_pct, {pct(ub, units, 1)} AS return_rate_pct,
               {rnd(adj, 2)} AS returns_adjusted_profit, RANK() OVER (ORDER BY adj DESC) AS adjusted_profit_rank
        FROM (SELECT s.cat AS category, s.net, s.gp, s.units, COALESCE(r.units, 0) AS ub,
                     {d(s.gp)} - {d(COALESCE(r.refund, 0))} * ({d(s.gp)} / {d(s.net)}) AS adj
              FROM (SELECT cat, SUM(net) AS net, SUM(net) - SUM(qty * cost) AS gp, SUM(qty) AS units
                    FROM sale GROUP BY cat) s
              LEFT JOIN (SELECT cat, SUM(back) AS units, SUM(refund) AS refund FROM back GROUP BY cat) r
                ON r.cat = s.cat)""",
    "category_premium_volume": """
        SELECT cat AS category, {avg(net, units, 2)} AS avg_unit_price, {b(units)} AS units_sold,
               {avg(all_net, all_units, 2)} AS portfolio_avg_price,
               CASE WHEN {d(net)} / {d(units)} >= {d(all_net)} / {d(all_units)} AND units < mean THEN 'PREMIUM'
                    WHEN {d(net)} / {d(units)} < {d(all_net)} / {d(all_units)} AND units > mean THEN 'VOLUME'
                    ELSE 'BALANCED' END AS classification
        FROM (SELECT cat, SUM(net) AS net, SUM(qty) AS units, SUM(SUM(net)) OVER () AS all_net,
                     SUM(SUM(qty)) OVER () AS all_units, AVG(SUM(qty)) OVER () AS mean FROM sale GROUP BY cat)""",
    "category_quadrants": """
        SELECT cat AS category, {d(net)} AS revenue, {pct(gp, net, 1)} AS margin_pct,
               concat(CASE WHEN {d(net)} < med THEN 'Low' ELSE 'High' END, ' Revenue / ',
                      CASE WHEN {d(gp)} / {d(net)} < blend THEN 'Low' ELSE 'High' END, ' Margin') AS portfolio_quadrant
        FROM (SELECT cat, SUM(net) AS net, SUM(net) - SUM(qty * cost) AS gp FROM sale GROUP BY cat),
             (SELECT {med(net)} AS med FROM (SELECT SUM(net) AS net FROM sale GROUP BY cat)),
             (SELECT {d(SUM(net) - SUM(qty * cost))} / {d(SUM(net))} AS blend FROM sale)""",
    # -- geography -------------------------------------------------------------
    "region_revenue": """
        SELECT w.region, COUNT(DISTINCT h.cust) AS purchasing_customers, COUNT(*) AS orders,
               {d(SUM(h.net))} AS order_net_revenue, {pct(SUM(h.net), (SELECT SUM(net) FROM hdr), 1)} AS pct_of_revenue
        FROM hdr h JOIN who w ON w.cust = h.cust GROUP BY w.region""",
    "region_rpc_index": """
        SELECT region, COUNT(*) AS customers, {d(SUM(net))} AS revenue,
               {avg(SUM(net), COUNT(*), 2)} AS revenue_per_customer,
               {avg((SELECT SUM(net) FROM purse), (SELECT COUNT(*) FROM purse), 2)} AS national_rpc,
               {pct({d(SUM(net))} / COUNT(*), (SELECT {d(SUM(net))} / COUNT(*) FROM purse), 1)} AS rpc_index
        FROM purse GROUP BY region HAVING SUM(orders) > 0""",
    "city_rpc_index": """
        SELECT w.geo AS geography_key, w.city, w.region, COUNT(*) AS customers,
               {avg(SUM(p.net), COUNT(*), 2)} AS revenue_per_customer,
               {pct({d(SUM(p.net))} / COUNT(*), (SELECT {d(SUM(net))} / COUNT(*) FROM purse), 1)} AS rpc_index,
               CASE WHEN COUNT(*) >= 55 THEN 'RELIABLE' ELSE 'LOW_BASE_CAUTION' END AS sample_reliability
        FROM who w JOIN purse p ON p.cust = w.cust GROUP BY w.geo, w.city, w.region HAVING SUM(p.orders) > 0""",
    "region_customer_quality": """
        SELECT region, COUNT(*) AS total_customers, COUNT(*) FILTER (WHERE orders > 0) AS purchasing_customers,
               {pct(COUNT(*) FILTER (WHERE orders > 1), COUNT(*), 1)} AS repeat_rate_pct,
               {avg(SUM(net), SUM(orders), 2)} AS aov, {avg(SUM(net), COUNT(*), 2)} AS revenue_per_customer
        FROM purse GROUP BY region HAVING SUM(orders) > 0""",
    "region_yoy": """
        SELECT region, {d(a)} AS rev_year_1, {d(b)} AS rev_year_2, {d(c)} AS rev_year_3,
               {pct(b - a, a, 1)} AS yoy_year_2_pct, {pct(c - b, b, 1)} AS yoy_year_3_pct
        FROM (SELECT w.region, SUM(h.net) FILTER (WHERE year(h.day) = 1995) AS a,
                     SUM(h.net) FILTER (WHERE year(h.day) = 1996) AS b,
                     SUM(h.net) FILTER (WHERE year(h.day) = 1997) AS c
              FROM hdr h JOIN who w ON w.cust = h.cust GROUP BY w.region)""",
    "region_acquisition_by_year": """
        SELECT region, COUNT(*) FILTER (WHERE year(signup) = 1995) AS acquired_year_1,
               COUNT(*) FILTER (WHERE year(signup) = 1996) AS acquired_year_2,
               COUNT(*) FILTER (WHERE year(signup) = 1997) AS acquired_year_3
        FROM who GROUP BY region""",
    "region_quadrants": """
        SELECT region, {d(net)} AS revenue, {avg(net, n, 2)} AS revenue_per_customer,
               {pct({d(net)} / n, nat, 1)} AS rpc_index,
               concat(CASE WHEN {d(net)} < med THEN 'Low' ELSE 'High' END, ' Revenue / ',
                      CASE WHEN {d(net)} / n < nat THEN 'Low' ELSE 'High' END, ' Value') AS portfolio_quadrant
        FROM (SELECT region, SUM(net) AS net, COUNT(*) AS n FROM purse GROUP BY region HAVING SUM(orders) > 0),
             (SELECT {med(net)} AS med FROM (SELECT SUM(net) AS net FROM purse GROUP BY region HAVING SUM(orders) > 0)),
             (SELECT {d(SUM(net))} / COUNT(*) AS nat FROM purse)""",
    # -- marketing -------------------------------------------------------------
    "channel_volume": """
        SELECT seg AS channel_name, 'Segment' AS channel_category, COUNT(*) AS customers_acquired,
               COUNT(*) FILTER (WHERE orders > 0) AS purchasing_customers, {b(SUM(orders))} AS orders,
               {d(SUM(net))} AS order_net_revenue, {pct(SUM(net), SUM(SUM(net)) OVER (), 1)} AS pct_of_revenue,
               {pct(COUNT(*), SUM(COUNT(*)) OVER (), 1)} AS pct_of_customers
        FROM purse GROUP BY seg""",
    "channel_customer_quality": """
        SELECT seg AS channel_name, COUNT(*) AS acquired_customers,
               {avg(SUM(net), COUNT(*), 2)} AS revenue_per_customer,
               {pct(COUNT(*) FILTER (WHERE orders > 1), COUNT(*), 1)} AS repeat_rate_pct,
               {avg(SUM(net), SUM(orders), 2)} AS aov,
               {avg(SUM(orders), COUNT(*) FILTER (WHERE orders > 0), 2)} AS orders_per_purchasing_customer
        FROM purse GROUP BY seg""",
    "campaign_type_performance": """
        SELECT p.campaign_type, COUNT(*) AS orders, {d(SUM(h.net))} AS campaign_revenue_gross,
               {avg(SUM(h.net), COUNT(*), 2)} AS aov,
               {pct(SUM(h.net), SUM(SUM(h.net)) OVER (), 1)} AS pct_of_campaign_revenue
        FROM hdr h JOIN promo_day x ON x.d = h.day JOIN promo p ON p.campaign_key = x.campaign_key
        GROUP BY p.campaign_type""",
    "channel_value_vs_volume": """
        SELECT seg AS channel_name, 'Segment' AS channel_category, {rnd(100.0 * vol, 1)} AS customer_share_pct,
               {rnd(100.0 * val, 1)} AS revenue_share_pct, {rnd(100.0 * val - 100.0 * vol, 1)} AS value_vs_volume_gap,
               {avg(net, n, 2)} AS revenue_per_customer, {pct(again, n, 1)} AS repeat_rate_pct
        FROM (SELECT seg, SUM(net) AS net, COUNT(*) AS n, COUNT(*) FILTER (WHERE orders > 1) AS again,
                     {d(SUM(net))} / {d(SUM(SUM(net)) OVER ())} AS val, {d(COUNT(*))} / {d(SUM(COUNT(*)) OVER ())} AS vol
              FROM purse GROUP BY seg)""",
    "channel_mix_by_region": """
        SELECT region, seg AS channel_name, COUNT(*) AS customers,
               {pct(COUNT(*), SUM(COUNT(*)) OVER (PARTITION BY region), 1)} AS pct_of_region
        FROM who GROUP BY region, seg""",
    "category_mix_by_channel": """
        SELECT w.seg AS channel_name,
               {pct(SUM(CASE WHEN s.cat = 'ECONOMY' THEN s.net ELSE 0 END), SUM(s.net), 1)} AS category_1_pct,
               {pct(SUM(CASE WHEN s.cat = 'LARGE' THEN s.net ELSE 0 END), SUM(s.net), 1)} AS category_2_pct,
               {pct(SUM(CASE WHEN s.cat = 'PROMO' THEN s.net ELSE 0 END), SUM(s.net), 1)} AS category_3_pct,
               {d(SUM(s.net))} AS channel_category_revenue
        FROM sale s JOIN who w ON w.cust = s.cust GROUP BY w.seg""",
    "channel_quadrants": """
        SELECT seg AS channel_name, n AS customers, {avg(net, n, 2)} AS revenue_per_customer,
               {pct({d(net)} / n, nat, 1)} AS rpc_index,
               concat(CASE WHEN n < med THEN 'Low' ELSE 'High' END, ' Volume / ',
                      CASE WHEN {d(net)} / n < nat THEN 'Low' ELSE 'High' END, ' Value') AS portfolio_quadrant
        FROM (SELECT seg, SUM(net) AS net, COUNT(*) AS n FROM purse GROUP BY seg),
             (SELECT {med(n)} AS med FROM (SELECT COUNT(*) AS n FROM purse GROUP BY seg)),
             (SELECT {d(SUM(net))} / COUNT(*) AS nat FROM purse)""",
    # -- retention -------------------------------------------------------------
    "customer_portfolio_split": """
        SELECT CASE WHEN orders = 0 THEN 'Never Purchased' WHEN orders = 1 THEN 'One-Time' ELSE 'Repeat (2+)' END AS segment,
               COUNT(*) AS customers, {pct(COUNT(*), (SELECT COUNT(*) FROM purse), 1)} AS pct_of_customers,
               {b(SUM(orders))} AS orders, {d(SUM(net))} AS order_net_revenue,
               {pct(SUM(net), (SELECT SUM(net) FROM purse), 1)} AS pct_of_revenue
        FROM purse GROUP BY 1""",
    "frequency_tier_value": """
        SELECT CASE WHEN orders >= 7 THEN '7+ - Loyal' WHEN orders >= 4 THEN '4-6 - Regular'
                    WHEN orders >= 2 THEN '2-3 - Occasional' WHEN orders = 1 THEN '1 - One-time'
                    ELSE '0 - Never' END AS value_segment, COUNT(*) AS customers,
               {pct(COUNT(*), (SELECT COUNT(*) FROM purse), 1)} AS pct_of_customers, {d(SUM(value))} AS net_revenue,
               {pct(SUM(value), (SELECT SUM(value) FROM purse), 1)} AS pct_of_net_revenue,
               {avg(SUM(value), COUNT(*), 2)} AS avg_clv_net, {avg(SUM(orders), COUNT(*), 2)} AS avg_orders,
               {avg(SUM(net), SUM(orders), 2)} AS aov
        FROM purse GROUP BY 1""",
    "value_deciles": """
        SELECT decile, COUNT(*) AS customers, {d(SUM(value))} AS net_revenue,
               {pct(SUM(value), SUM(SUM(value)) OVER (), 1)} AS pct_of_net_revenue,
               {pct(SUM(SUM(value)) OVER (ORDER BY decile), SUM(SUM(value)) OVER (), 1)} AS cumulative_pct
        FROM ranked_buyers GROUP BY decile""",
    "repeat_vs_one_time": """
        SELECT CASE orders WHEN 1 THEN 'One-Time' ELSE 'Repeat (2+)' END AS segment, COUNT(*) AS customers,
               {b(SUM(orders))} AS total_orders, {d(SUM(net))} AS order_net_revenue,
               {pct(SUM(net), SUM(SUM(net)) OVER (), 1)} AS pct_of_revenue,
               {avg(SUM(net), COUNT(*), 2)} AS avg_lifetime_revenue,
               {avg(SUM(orders), COUNT(*), 2)} AS avg_orders_per_customer, {avg(SUM(net), SUM(orders), 2)} AS aov
        FROM purse WHERE orders > 0 GROUP BY 1""",
    "snapshot_frequency_state": """
        SELECT CASE WHEN n >= 7 THEN '7+ orders' WHEN n >= 4 THEN '4-6 orders' WHEN n >= 2 THEN '2-3 orders'
                    WHEN n = 1 THEN '1 order' ELSE '0 orders' END AS frequency_tier, COUNT(*) AS customers,
               {rnd(AVG(rec), 0)} AS avg_recency_days, COUNT(*) FILTER (WHERE rec <= 90) AS active_customers,
               {pct(COUNT(*) FILTER (WHERE rec <= 90), COUNT(*), 1)} AS active_pct
        FROM snap WHERE me = (SELECT horizon FROM span) GROUP BY 1""",
    "repeat_90d_rate": """
        SELECT COUNT(*) AS customers_with_first_order, COUNT(*) FILTER (WHERE gap <= 90) AS repeat_within_90d,
               {pct(COUNT(*) FILTER (WHERE gap <= 90), COUNT(*), 1)} AS repeat_90d_rate_pct
        FROM (SELECT cust, date_diff('day', day, LEAD(day) OVER (PARTITION BY cust ORDER BY day)) AS gap,
                     ROW_NUMBER() OVER (PARTITION BY cust ORDER BY day) AS k
              FROM (SELECT DISTINCT cust, day FROM hdr)) WHERE k = 1""",
    "high_value_by_region": """
        SELECT region, COUNT(*) FILTER (WHERE decile = 1) AS high_value_customers, COUNT(*) AS all_purchasers,
               {pct(COUNT(*) FILTER (WHERE decile = 1), COUNT(*), 1)} AS high_value_pct
        FROM ranked_buyers GROUP BY region""",
    "high_value_by_channel": """
        SELECT seg AS channel_name, COUNT(*) FILTER (WHERE decile = 1) AS high_value_customers,
               COUNT(*) AS all_purchasers, {pct(COUNT(*) FILTER (WHERE decile = 1), COUNT(*), 1)} AS high_value_pct
        FROM ranked_buyers GROUP BY seg""",
    "high_value_category_mix": """
        SELECT CASE r.decile WHEN 1 THEN 'Top decile (high value)' ELSE 'Deciles 2-10' END AS customer_group,
               {pct(SUM(CASE WHEN s.cat = 'ECONOMY' THEN s.net ELSE 0 END), SUM(s.net), 1)} AS category_1_pct,
               {pct(SUM(CASE WHEN s.cat = 'LARGE' THEN s.net ELSE 0 END), SUM(s.net), 1)} AS category_2_pct,
               {pct(SUM(CASE WHEN s.cat = 'PROMO' THEN s.net ELSE 0 END), SUM(s.net), 1)} AS category_3_pct
        FROM ranked_buyers r JOIN sale s ON s.cust = r.cust GROUP BY 1""",
    # -- returns ---------------------------------------------------------------
    "returns_overview": """
        SELECT COUNT(*) AS total_returns, {b(SUM(back))} AS units_returned, {d(SUM(refund))} AS revenue_refunded,
               {d(SUM(fee))} AS restocking_recovered, {d(SUM(refund - fee))} AS net_revenue_leakage,
               {pct(SUM(refund), (SELECT SUM(net) FROM hdr), 1)} AS refund_pct_of_order_net_rev
        FROM back""",
    "return_reasons": """
        SELECT n.reason_description, n.is_controllable, COUNT(*) AS returns, {b(SUM(b.back))} AS units,
               {d(SUM(b.refund))} AS revenue_returned,
               {pct(SUM(b.refund), SUM(SUM(b.refund)) OVER (), 1)} AS pct_of_returned_value
        FROM back b JOIN reason_names n ON n.reason = b.reason GROUP BY ALL""",
    "return_controllability": """
        SELECT n.is_controllable, {d(SUM(b.refund))} AS revenue_returned,
               {pct(SUM(b.refund), (SELECT SUM(refund) FROM back), 1)} AS pct_of_returned_value
        FROM back b JOIN reason_names n ON n.reason = b.reason GROUP BY n.is_controllable""",
    "category_return_drivers": """
        SELECT s.cat AS category, {pct(r.units, s.units, 1)} AS return_rate_pct, {d(r.refund)} AS revenue_returned,
               {pct(r.named, r.refund, 1)} AS named_reason_pct_of_returns
        FROM (SELECT cat, SUM(qty) AS units FROM sale GROUP BY cat) s
        JOIN (SELECT cat, SUM(back) AS units, SUM(refund) AS refund,
                     COALESCE(SUM(refund) FILTER (WHERE reason = 1), 0) AS named FROM back GROUP BY cat) r
          ON r.cat = s.cat""",
    "return_rate_by_frequency": """
        SELECT CASE WHEN orders >= 7 THEN '7+ - Loyal' WHEN orders >= 4 THEN '4-6 - Regular'
                    WHEN orders >= 2 THEN '2-3 - Occasional' WHEN orders = 1 THEN '1 - One-time'
                    ELSE '0 - Never' END AS value_segment, COUNT(*) AS customers,
               {pct(SUM(units_back), SUM(units), 1)} AS return_rate_pct, {d(SUM(refund))} AS revenue_returned
        FROM purse GROUP BY 1""",
    "return_rate_bands": """
        SELECT CASE WHEN units_back = 0 THEN '0% - no returns'
                    WHEN 100 * units_back >= 60 * units THEN '60%+ - high-return cluster'
                    WHEN 100 * units_back >= 40 * units THEN '40-59%'
                    WHEN 100 * units_back >= 20 * units THEN '20-39%' ELSE '1-19%' END AS return_rate_band,
               COUNT(*) AS customers, {pct(COUNT(*), SUM(COUNT(*)) OVER (), 1)} AS pct_of_purchasers
        FROM purse WHERE orders > 0 GROUP BY 1""",
    "top_decile_net_of_returns": """
        SELECT CASE decile WHEN 1 THEN 'Top decile' ELSE 'Deciles 2-10' END AS customer_group, COUNT(*) AS customers,
               {d(SUM(net))} AS gross_value, {d(SUM(value))} AS net_value_after_returns,
               {pct(SUM(refund), SUM(net), 1)} AS pct_lost_to_returns
        FROM ranked_buyers GROUP BY 1""",
    "region_return_rate": """
        SELECT region, {pct(SUM(units_back), SUM(units), 1)} AS return_rate_pct, {b(SUM(units_back))} AS units_returned
        FROM purse GROUP BY region HAVING SUM(units_back) > 0""",
    "channel_return_rate": """
        SELECT seg AS channel_name, {pct(SUM(units_back), SUM(units), 1)} AS return_rate_pct,
               {b(SUM(units_back))} AS units_returned
        FROM purse GROUP BY seg HAVING SUM(units_back) > 0""",
    "value_leakage_ranked": """
        SELECT src AS leakage_source, cls AS leakage_class, dollars,
               CASE cls WHEN 'Realized' THEN {pct(dollars, SUM(CASE cls WHEN 'Realized' THEN dollars END) OVER (), 1)}
                   END AS pct_of_realized_leakage
        FROM (SELECT CASE WHEN n.is_controllable THEN 'Returns - controllable' ELSE 'Returns - non-controllable' END
                     AS src, 'Realized' AS cls, {d(SUM(b.refund))} AS dollars
              FROM back b JOIN reason_names n ON n.reason = b.reason GROUP BY 1
              UNION ALL SELECT 'Discounts given', 'Realized', {d(SUM(disc))} FROM hdr
              UNION ALL SELECT 'Never-purchased customers', 'Realized', 0.0::DOUBLE
              UNION ALL SELECT 'One-time customers - opportunity cost', 'Opportunity',
                     {rnd((AVG({d(net)}) FILTER (WHERE orders > 1) - AVG({d(net)}) FILTER (WHERE orders = 1))
                          * COUNT(*) FILTER (WHERE orders = 1), 2)}
              FROM purse WHERE orders > 0)""",
    # -- rfm -------------------------------------------------------------------
    "frequency_distribution": """
        SELECT {quant(freq, 0.5, 0)} AS freq_median, {quant(freq, 0.75, 0)} AS freq_p75,
               {quant(freq, 0.9, 0)} AS freq_p90, {quant(freq, 0.95, 0)} AS freq_p95, MAX(freq) AS freq_max,
               {avg(SUM(freq), COUNT(*), 2)} AS freq_mean
        FROM rfm0""",
    "rfm_scores": """
        SELECT cust AS customer_key, {i(rec)} AS recency_days, freq AS frequency, {d(mon)} AS monetary,
               r AS r_score, f AS f_score, m AS m_score FROM rfm""",
    "rfm_score_distribution": """
        SELECT r AS r_score, f AS f_score, m AS m_score, COUNT(*) AS customers FROM rfm GROUP BY ALL""",
    "rfm_segments": """
        SELECT cust AS customer_key, {i(rec)} AS recency_days, freq AS frequency, {d(mon)} AS monetary,
               r AS r_score, f AS f_score, m AS m_score, code AS rfm_code, segment FROM rfm""",
    "rfm_segment_summary": """
        SELECT segment, COUNT(*) AS customers, {pct(COUNT(*), (SELECT COUNT(*) FROM rfm), 1)} AS pct_of_customers,
               {d(SUM(mon))} AS net_revenue, {pct(SUM(mon), (SELECT SUM(mon) FROM rfm), 1)} AS pct_of_net_revenue,
               {avg(SUM(mon), COUNT(*), 2)} AS avg_clv, {avg(SUM(freq), COUNT(*), 2)} AS avg_orders,
               {avg(SUM(rec), COUNT(*), 0)} AS avg_recency_days
        FROM rfm GROUP BY segment""",
    "rfm_reconciliation": """
        SELECT {d(SUM(mon))} AS rfm_net_revenue, COUNT(*) AS scored_customers,
               (SELECT COUNT(*) FROM customer) - COUNT(*) AS non_purchasers,
               CASE WHEN SUM(mon) = (SELECT SUM(net) FROM hdr) - (SELECT SUM(refund) FROM back)
                    AND COUNT(segment) = COUNT(*) THEN 'PASS' ELSE 'FAIL' END AS regression_result
        FROM rfm""",
    # -- cohorts ---------------------------------------------------------------
    "cohort_base": """
        SELECT cohort AS cohort_month, size AS cohort_customers, obs AS observable_months,
               maturity AS maturity_class FROM cohort""",
    "cohort_maturity_summary": """
        SELECT maturity AS maturity_class, COUNT(*) AS cohorts, {b(SUM(size))} AS customers,
               MIN(obs) AS min_observable_months, MAX(obs) AS max_observable_months
        FROM cohort GROUP BY maturity""",
    "cohort_retention": """
        SELECT cohort AS cohort_month, maturity AS maturity_class, size AS cohort_customers,
               obs AS observable_months, age AS age_months, active AS active_customers, pct AS retention_pct
        FROM kept""",
    "cohort_retention_curve": """
        SELECT age AS age_months, {rnd(AVG(pct), 1)} AS avg_retention_pct, {b(SUM(active))} AS total_active
        FROM kept WHERE maturity = 'Fully Mature' AND age <= 12 GROUP BY age""",
    "engagement_curve": """
        SELECT msfp AS age_months, COUNT(*) AS buyers_at_age, COUNT(*) FILTER (WHERE rec <= 90) AS engaged_customers,
               {pct(COUNT(*) FILTER (WHERE rec <= 90), COUNT(*), 1)} AS engagement_pct
        FROM snap WHERE msfp <= 12 GROUP BY msfp""",
    "cohort_revenue": """
        SELECT maturity AS maturity_class, COUNT(DISTINCT cohort) AS cohorts,
               {d(CASE WHEN SUM(orders) > 0 THEN SUM(net) END)} AS order_net_revenue, {b(SUM(orders))} AS orders,
               {avg(SUM(net), SUM(orders), 2)} AS aov
        FROM classed GROUP BY maturity""",
    "cohort_customer_value": """
        SELECT maturity AS maturity_class, COUNT(*) AS customers, {d(SUM(value))} AS net_revenue,
               {avg(SUM(value), COUNT(*), 2)} AS value_per_acquired_customer
        FROM classed GROUP BY maturity""",
    "cohort_rfm_mix": """
        SELECT c.maturity AS maturity_class, s.segment, COUNT(*) AS customers,
               {pct(COUNT(*), SUM(COUNT(*)) OVER (PARTITION BY c.maturity), 1)} AS pct_of_cohort_class
        FROM rfm s JOIN classed c ON c.cust = s.cust
        WHERE list_contains(['Champions', 'Loyal', 'At Risk', 'Lost'], s.segment) GROUP BY c.maturity, s.segment""",
    # -- lifetime value --------------------------------------------------------
    "historical_clv": """
        SELECT cust AS customer_key, orders AS lifetime_orders, {d(value)} AS historical_clv FROM purse""",
    "clv_value_tiers": """
        SELECT CASE WHEN orders > 0 AND value <> 0 THEN '3 Positive Historical CLV' WHEN orders > 0
                    THEN '2 Zero-net buyer' ELSE '1 Non-purchaser' END AS value_tier, COUNT(*) AS customers,
               {pct(COUNT(*), (SELECT COUNT(*) FROM purse), 1)} AS pct_of_base, {d(SUM(value))} AS total_historical_clv,
               {pct(SUM(value), (SELECT SUM(value) FROM purse), 1)} AS pct_of_total_clv
        FROM purse GROUP BY 1""",
    "clv_percentiles": """
        SELECT COUNT(*) AS positive_clv_customers, {quant(value, 0.25, 2)} AS p25,
               {quant(value, 0.5, 2)} AS median_clv, {quant(value, 0.75, 2)} AS p75, {quant(value, 0.9, 2)} AS p90,
               {quant(value, 0.95, 2)} AS p95, {avg(SUM(value), COUNT(*), 2)} AS mean_clv_context_only,
               {d(MAX(value))} AS max_clv
        FROM purse WHERE value > 0""",
    "clv_value_classes": """
        SELECT class AS historical_value_class, COUNT(*) AS customers,
               {pct(COUNT(*), SUM(COUNT(*)) OVER (), 1)} AS pct_of_positive,
               {avg(SUM(value), COUNT(*), 2)} AS avg_historical_clv, {d(SUM(value))} AS total_historical_clv,
               {pct(SUM(value), SUM(SUM(value)) OVER (), 1)} AS pct_of_positive_clv
        FROM traits GROUP BY class""",
    "clv_by_rfm_segment": """
        SELECT s.segment, COUNT(*) AS customers, {avg(SUM(p.value), COUNT(*), 2)} AS avg_historical_clv,
               {quant(p.value, 0.5, 2)} AS median_historical_clv, {d(SUM(p.value))} AS total_historical_clv,
               {pct(SUM(p.value), SUM(SUM(p.value)) OVER (), 1)} AS portfolio_clv_share_pct
        FROM rfm s JOIN purse p ON p.cust = s.cust GROUP BY s.segment""",
    # -- concentration ---------------------------------------------------------
    "concentration_bases": """
        SELECT basis AS analytical_basis, COUNT(*) AS customers, {d(SUM(value))} AS total_historical_clv
        FROM bases GROUP BY basis""",
    "topn_ladder": """
        SELECT basis AS analytical_basis,
               {pct(SUM(value) FILTER (WHERE k <= n * 0.01), SUM(value), 1)} AS top_1_pct,
               {pct(SUM(value) FILTER (WHERE k <= n * 0.05), SUM(value), 1)} AS top_5_pct,
               {pct(SUM(value) FILTER (WHERE k <= n * 0.10), SUM(value), 1)} AS top_10_pct,
               {pct(SUM(value) FILTER (WHERE k <= n * 0.20), SUM(value), 1)} AS top_20_pct,
               {pct(SUM(value) FILTER (WHERE k <= n * 0.50), SUM(value), 1)} AS top_50_pct
        FROM (SELECT basis, value, COUNT(*) OVER (PARTITION BY basis) AS n,
                     ROW_NUMBER() OVER (PARTITION BY basis ORDER BY value DESC, cust) AS k FROM bases)
        GROUP BY basis""",
    "top_decile_share": """
        SELECT COUNT(*) AS purchaser_base,
               {pct(SUM(value) FILTER (WHERE decile = 1), SUM(value), 1)} AS top_decile_share_pct
        FROM ranked_buyers""",
    "lorenz_curve": """
        SELECT {pct(k, n, 1)} AS cumulative_customer_pct, {pct(run, whole, 2)} AS cumulative_value_pct
        FROM (SELECT ROW_NUMBER() OVER (ORDER BY value, cust) AS k, COUNT(*) OVER () AS n,
                     SUM(value) OVER (ORDER BY value, cust) AS run, SUM(value) OVER () AS whole FROM purse)
        WHERE (k * 10) % n = 0""",
    "gini": """
        SELECT basis AS analytical_basis,
               {rnd(2.0 * {d(SUM(k * value))} / ({d(COUNT(*))} * {d(SUM(value))}) - (COUNT(*) + 1.0) / {d(COUNT(*))}, 4)}
                   AS gini_coefficient
        FROM (SELECT basis, value, ROW_NUMBER() OVER (PARTITION BY basis ORDER BY value, cust) AS k FROM bases)
        GROUP BY basis""",
    # -- behaviour -------------------------------------------------------------
    "behavioral_features": """
        SELECT cust AS customer_key, orders AS order_frequency, class AS historical_value_class,
               cats AS category_breadth, chans AS channel_breadth, {rnd(cadence, 4)} AS purchase_cadence_days,
               {d(value)} AS historical_clv FROM traits""",
    "behavior_population": """
        SELECT unnest(['Positive Historical CLV', 'Excluded - zero-net buyers', 'Excluded - non-purchasers',
                       'Customer base']) AS population,
               unnest([COUNT(*) FILTER (WHERE value > 0), COUNT(*) FILTER (WHERE value = 0 AND orders > 0),
                       COUNT(*) FILTER (WHERE orders = 0), COUNT(*)]) AS customers
        FROM purse""",
    "behavior_by_value_class": """
        SELECT class AS historical_value_class, COUNT(*) AS customers, {med(orders)} AS median_order_frequency_control,
               {med(cats)} AS median_category_breadth, {quant(cats, 0.25, 1)} AS cat_breadth_p25,
               {quant(cats, 0.75, 1)} AS cat_breadth_p75, {med(chans)} AS median_channel_breadth,
               {quant(cadence, 0.5, 0)} AS median_cadence_days, {quant(cadence, 0.25, 0)} AS cadence_p25,
               {quant(cadence, 0.75, 0)} AS cadence_p75
        FROM traits GROUP BY class""",
    "breadth_controlled": """
        SELECT orders AS order_frequency_stratum, cats AS category_breadth, COUNT(*) AS customers,
               {quant(value, 0.5, 2)} AS median_historical_clv, {avg(SUM(value), COUNT(*), 2)} AS mean_historical_clv,
               CASE WHEN COUNT(*) >= 30 THEN 'RELIABLE' ELSE 'LOW_BASE' END AS cell_reliability
        FROM traits WHERE orders BETWEEN 3 AND 6 GROUP BY orders, cats""",
    "channel_breadth_controlled": """
        SELECT orders AS order_frequency_stratum, chans AS channel_breadth, COUNT(*) AS customers,
               {quant(value, 0.5, 2)} AS median_historical_clv,
               CASE WHEN COUNT(*) >= 30 THEN 'RELIABLE' ELSE 'LOW_BASE' END AS cell_reliability
        FROM traits WHERE orders = 4 OR orders = 6 GROUP BY orders, chans""",
    "cadence_controlled": """
        SELECT orders AS order_frequency_stratum,
               CASE WHEN cadence >= 280 THEN '3 Slow' WHEN cadence >= 180 THEN '2 Moderate' ELSE '1 Fast' END
                   AS cadence_band, COUNT(*) AS customers, {quant(value, 0.5, 2)} AS median_historical_clv,
               CASE WHEN COUNT(*) >= 30 THEN 'RELIABLE' ELSE 'LOW_BASE' END AS cell_reliability
        FROM traits WHERE (orders = 4 OR orders = 6) AND cadence IS NOT NULL GROUP BY 1, 2""",
    "non_explanatory_variables": """
        SELECT class AS historical_value_class, COUNT(*) AS customers,
               {quant({d(net)} / orders, 0.5, 2)} AS median_basket_value,
               {pct(SUM(units_back), SUM(units), 1)} AS return_rate_pct,
               {quant(100.0 * {d(disc)} / NULLIF({d(gross)}, 0), 0.5, 1)} AS median_discount_share_pct
        FROM traits GROUP BY class""",
    "behavior_by_rfm_segment": """
        SELECT s.segment, COUNT(*) AS customers, {med(t.cats)} AS median_category_breadth,
               {med(t.chans)} AS median_channel_breadth, {quant(t.cadence, 0.5, 0)} AS median_cadence_days
        FROM traits t JOIN rfm s ON s.cust = t.cust GROUP BY s.segment""",
    # -- portfolio -------------------------------------------------------------
    "customer_portfolio": """
        SELECT cust AS customer_key, orders AS lifetime_orders, {d(value)} AS historical_clv,
               class AS historical_value_class, segment AS rfm_segment, code AS rfm_code, grp AS executive_framework,
               cats AS category_breadth, chans AS channel_breadth, {rnd(cadence, 4)} AS purchase_cadence_days,
               pos AS portfolio_value_rank, {pct(pos, n, 2)} AS portfolio_value_percentile FROM folio""",
    "portfolio_composition": """
        SELECT COUNT(*) AS total_customers, COUNT(segment) AS rfm_scored, COUNT(cats) AS behavioral_population,
               COUNT(*) - COUNT(segment) AS excluded_non_purchasers,
               COUNT(segment) - COUNT(cats) AS excluded_zero_net_buyers, {d(SUM(value))} AS total_historical_clv
        FROM folio""",
    "classification_drift": """
        SELECT COUNT(*) FILTER (WHERE p.segment IS DISTINCT FROM s.segment) AS rfm_segment_drift,
               COUNT(*) FILTER (WHERE p.class IS DISTINCT FROM t.class) AS value_class_drift
        FROM folio p LEFT JOIN rfm s ON s.cust = p.cust LEFT JOIN traits t ON t.cust = p.cust""",
    "method_convergence": """
        SELECT unnest(['A RFM Champions', 'B Elite value class', 'C Top value decile', 'A and B', 'A and C', 'B and C',
                       'A and B and C']) AS method_or_overlap,
               unnest([{b(SUM(a))}, {b(SUM(e))}, {b(SUM(t))}, {b(SUM(a * e))}, {b(SUM(a * t))}, {b(SUM(e * t))},
                       {b(SUM(a * e * t))}]) AS customers
        FROM (SELECT CASE segment WHEN 'Champions' THEN 1 ELSE 0 END AS a,
                     CASE class WHEN '4 Elite' THEN 1 ELSE 0 END AS e,
                     CASE WHEN value > 0 AND pos <= 0.1 * (SELECT COUNT(*) FROM folio WHERE value > 0) THEN 1
                          ELSE 0 END AS t
              FROM folio)""",
    "method_disagreement": """
        SELECT x.label AS disagreement_population, COUNT(f.cust) AS customers,
               {quant(f.value, 0.5, 2)} AS median_historical_clv, {quant(f.cadence, 0.5, 0)} AS median_cadence_days
        FROM (VALUES ('Elite but NOT Champion', TRUE), ('Champion but NOT Elite', FALSE)) AS x(label, rich)
        LEFT JOIN folio f ON (COALESCE(f.class, '') = '4 Elite') = x.rich
              AND (COALESCE(f.segment, '') = 'Champions') <> x.rich
        GROUP BY x.label""",
    "portfolio_by_framework": """
        SELECT grp AS executive_framework, COUNT(*) AS customers,
               {pct(COUNT(*), SUM(COUNT(*)) OVER (), 1)} AS pct_of_portfolio, {d(SUM(value))} AS total_historical_clv,
               {pct(SUM(value), SUM(SUM(value)) OVER (), 1)} AS pct_of_portfolio_value,
               {med(cats)} AS median_category_breadth, {quant(cadence, 0.5, 0)} AS median_cadence_days
        FROM folio GROUP BY grp""",
}
