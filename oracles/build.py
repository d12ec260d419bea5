"""Shared tables of the statements, and the assembly of a statement from them.

Money is DECIMAL here and whole cents in the Spark jobs, customer gaps come from
LAG here and from first and last order there, ranks come from window functions
here and from a range sort there: the two sides share no arithmetic.
"""

from __future__ import annotations

import re

# name -> SELECT; a table may use those above it.
TABLES: dict[str, str] = {
    "span": """
        SELECT CAST(MIN(o_orderdate) AS DATE) AS first_any,
               CAST(MIN(o_orderdate) AS DATE) AS first_done,
               CAST(last_day(MAX(o_orderdate)) AS DATE) AS horizon
        FROM orders""",
    "cal0": """
        SELECT CAST(date_trunc('month', first_any) - INTERVAL 1 MONTH AS DATE) AS day0, horizon FROM span""",
    "sale0": """
        SELECT l.l_orderkey AS ord, l.l_partkey AS part, l.l_suppkey AS supp, l.l_linenumber AS ln,
               l.l_returnflag AS flag, o.o_custkey AS cust, CAST(o.o_orderdate AS DATE) AS day,
               o.o_orderpriority AS chan, CAST(l.l_quantity AS BIGINT) AS qty,
               CAST(l.l_extendedprice AS DECIMAL(12,2)) AS gross,
               CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2)
                    AS DECIMAL(12,2)) AS disc,
               CAST(p.p_retailprice AS DECIMAL(10,2)) AS cost, p.p_type AS cat, p.p_name AS pname
        FROM lineitem l, orders o, part p
        WHERE o.o_orderkey = l.l_orderkey AND p.p_partkey = l.l_partkey""",
    "sale": "SELECT *, CAST(gross - disc AS DECIMAL(12,2)) AS net FROM sale0",
    "hdr": """
        SELECT ord, any_value(cust) AS cust, any_value(day) AS day, any_value(chan) AS chan,
               SUM(gross) AS gross, SUM(disc) AS disc, SUM(net) AS net
        FROM sale GROUP BY ord""",
    "ret0": """
        SELECT *, CASE WHEN ln % 2 = 1 THEN qty ELSE (qty + 1) // 2 END AS back,
               1 + (part + ln) % 6 AS reason, day + CAST(5 + ord % 17 AS INTEGER) AS rday
        FROM sale WHERE flag = 'R'""",
    "ret": """
        SELECT *, CAST((CAST(net * 100 AS BIGINT) * back * 2 + qty) // (qty * 2) AS DECIMAL(18,0)) / 100 AS raw_refund
        FROM ret0 WHERE rday <= (SELECT horizon FROM span)""",
    "back": """
        SELECT ord, part, supp, ln, cust, day, rday, cat, qty, back, net, gross, CAST(reason AS INTEGER) AS reason,
               CAST(raw_refund AS DECIMAL(12,2)) AS refund,
               CAST(CASE WHEN reason = 4 THEN ROUND(CAST(raw_refund AS DECIMAL(12,2)) * 0.1, 2) ELSE 0 END
                    AS DECIMAL(12,2)) AS fee
        FROM ret""",
    "reason_names": """
        SELECT * FROM (VALUES (1, 'Wrong Size', TRUE), (2, 'Defective/Quality Issue', TRUE),
            (3, 'Not as Described', TRUE), (4, 'Changed Mind', FALSE), (5, 'Late Delivery', TRUE),
            (6, 'Other', FALSE)) AS t(reason, reason_description, is_controllable)""",
    "who": """
        SELECT c.c_custkey AS cust, c.c_mktsegment AS seg, c.c_nationkey AS geo, n.n_name AS city,
               r.r_name AS region,
               COALESCE((f.first_day - CAST(c.c_custkey % 30 AS INTEGER)), (SELECT day0 FROM cal0)) AS signup
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = n.n_regionkey
        LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY 1) f
          ON f.o_custkey = c.c_custkey""",
    "purse": """
        SELECT w.cust, w.seg, w.geo, w.region, w.signup, COALESCE(h.n, 0) AS orders,
               COALESCE(h.gross, 0) AS gross, COALESCE(h.disc, 0) AS disc, COALESCE(h.net, 0) AS net,
               COALESCE(h.net, 0) - COALESCE(b.refund, 0) AS value, COALESCE(b.refund, 0) AS refund,
               COALESCE(b.units, 0) AS units_back, COALESCE(u.units, 0) AS units, h.last_day
        FROM who w
        LEFT JOIN (SELECT cust, COUNT(*) AS n, SUM(gross) AS gross, SUM(disc) AS disc, SUM(net) AS net,
                          MAX(day) AS last_day FROM hdr GROUP BY cust) h ON h.cust = w.cust
        LEFT JOIN (SELECT cust, SUM(refund) AS refund, CAST(SUM(back) AS BIGINT) AS units FROM back GROUP BY cust) b
          ON b.cust = w.cust
        LEFT JOIN (SELECT cust, CAST(SUM(qty) AS BIGINT) AS units FROM sale GROUP BY cust) u ON u.cust = w.cust""",
    "ranked_buyers": """
        SELECT *, NTILE(10) OVER (ORDER BY value DESC, cust) AS decile FROM purse WHERE orders > 0""",
    "rfm0": """
        SELECT cust, date_diff('day', last_day, (SELECT horizon FROM span)) AS rec, orders AS freq, value AS mon
        FROM purse WHERE orders > 0""",
    "rfm1": """
        SELECT *, 6 - NTILE(5) OVER (ORDER BY rec, cust) AS r, NTILE(5) OVER (ORDER BY mon, cust) AS m,
               CASE WHEN freq >= 12 THEN 5 WHEN freq >= 7 THEN 4 WHEN freq >= 4 THEN 3 WHEN freq >= 2 THEN 2
                    ELSE 1 END AS f
        FROM rfm0""",
    "rfm": """
        SELECT cust, rec, freq, mon, CAST(r AS BIGINT) AS r, CAST(f AS BIGINT) AS f, CAST(m AS BIGINT) AS m,
               -- Fixed values: the ten segments by recency and frequency score.
               CASE WHEN r >= 4 AND f >= 4 THEN 'Champions'
                    WHEN r >= 3 AND f >= 3 THEN 'Loyal'
                    WHEN r >= 4 AND f = 2 THEN 'Potential Loyalists'
                    WHEN r >= 4 THEN 'New / Recent'
                    WHEN r = 3 THEN 'Promising'
                    WHEN r = 2 AND f >= 3 THEN 'Needs Attention'
                    WHEN r = 2 THEN 'At Risk'
                    WHEN f >= 4 THEN 'Cant Lose'
                    WHEN f >= 2 THEN 'Hibernating'
                    ELSE 'Lost' END AS segment,
               'R' || r || 'F' || f || 'M' || m AS code
        FROM rfm1""",
    "aged": """
        SELECT *, CAST(date_trunc('month', signup) AS DATE) AS cohort,
               date_diff('month', date_trunc('month', signup), date_trunc('month', (SELECT horizon FROM span))) AS obs
        FROM purse""",
    "classed": """
        SELECT *, CASE WHEN obs >= 12 THEN 'Fully Mature' WHEN obs >= 6 THEN 'Established'
                       WHEN obs >= 3 THEN 'Growing' ELSE 'Immature' END AS maturity FROM aged""",
    "cohort": "SELECT cohort, obs, maturity, COUNT(*) AS size FROM classed GROUP BY ALL",
    "visits": """
        SELECT c.cohort, c.maturity, c.obs,
               date_diff('month', c.cohort, date_trunc('month', h.day)) AS age, COUNT(DISTINCT c.cust) AS active
        FROM classed c JOIN hdr h ON h.cust = c.cust GROUP BY ALL""",
    "kept": """
        SELECT v.cohort, v.maturity, k.size, v.obs, v.age, v.active, {pct(v.active, k.size, 1)} AS pct
        FROM visits v JOIN cohort k ON k.cohort = v.cohort WHERE v.age >= 0""",
    "gaps": """
        SELECT cust, date_diff('day', LAG(day) OVER (PARTITION BY cust ORDER BY day), day) AS gap FROM hdr""",
    "traits": """
        SELECT p.cust, p.orders, p.value, p.gross, p.disc, p.net, p.units, p.units_back,
               CASE WHEN p.value >= 3000000 THEN '4 Elite' WHEN p.value >= 2000000 THEN '3 High'
                    WHEN p.value >= 1000000 THEN '2 Moderate' ELSE '1 Low' END AS class,
               b.cats, b.chans, g.cadence
        FROM purse p
        LEFT JOIN (SELECT cust, COUNT(DISTINCT cat) AS cats, COUNT(DISTINCT chan) AS chans FROM sale GROUP BY cust) b
          ON b.cust = p.cust
        LEFT JOIN (SELECT cust, AVG(gap) AS cadence FROM gaps WHERE gap IS NOT NULL GROUP BY cust) g
          ON g.cust = p.cust
        WHERE p.value > 0""",
    "folio": """
        SELECT p.cust, p.orders, p.value, t.class, s.segment, s.code, t.cats, t.chans, t.cadence,
               CASE WHEN s.segment IS NULL THEN '5 Not activated'
                    WHEN s.segment IN ('Champions', 'Loyal') THEN '1 Protect'
                    WHEN s.segment IN ('Potential Loyalists', 'Promising') THEN '2 Grow'
                    WHEN s.segment IN ('At Risk', 'Lost') THEN '3 Convert'
                    ELSE '4 Other' END AS grp,
               ROW_NUMBER() OVER (ORDER BY p.value DESC, p.cust) AS pos, COUNT(*) OVER () AS n
        FROM purse p LEFT JOIN rfm s ON s.cust = p.cust LEFT JOIN traits t ON t.cust = p.cust""",
    "bases": """
        SELECT 'Primary - complete portfolio' AS basis, cust, value FROM purse
        UNION ALL SELECT 'Reconciliation - purchaser base', cust, value FROM purse WHERE orders > 0""",
    # Calendar side.
    "years": """
        SELECT CAST(unnest(range(year(first_done), year(horizon) + 1)) AS INTEGER) AS y,
               year(first_done) AS y0 FROM span""",
    "thanks": """
        SELECT y, y0, CAST(make_date(y, 11, 22) + CAST((11 - isodow(make_date(y, 11, 22))) % 7 AS INTEGER) AS DATE)
               AS tg FROM years""",
    "promo": """
        SELECT CAST((y - y0) * 7 + k AS INTEGER) AS campaign_key, name || ' ' || y AS campaign_name,
               kind AS campaign_type, s AS start_date, e AS end_date, depth AS discount_depth, pc AS pct
        FROM thanks, LATERAL (VALUES
            (1, 'Spring Collection Launch', 'Seasonal Launch', make_date(y, 2, 15), make_date(y, 3, 15), 'None', 0),
            (2, 'Summer Sale', 'Promotional Sale', make_date(y, 7, 5), make_date(y, 7, 25), 'Moderate', 20),
            (3, 'Back-to-School', 'Promotional Sale', make_date(y, 8, 1), make_date(y, 8, 21), 'Moderate', 20),
            (4, 'Black Friday', 'Promotional Sale', tg + 1, tg + 3, 'Deep', 30),
            (5, 'Cyber Monday', 'Promotional Sale', tg + 4, tg + 4, 'Deep', 30),
            (6, 'Holiday Collection', 'Seasonal Launch', make_date(y, 11, 15), make_date(y, 12, 24), 'Light', 10),
            (7, 'January Clearance', 'Clearance', make_date(y, 1, 2), make_date(y, 1, 21), 'Deepest', 45))
            AS t(k, name, kind, s, e, depth, pc)""",
    "seasons": """
        SELECT CAST(m AS INTEGER) AS m, CASE WHEN m IN (12, 1, 2) THEN 'Winter' WHEN m <= 5 THEN 'Spring'
               WHEN m <= 8 THEN 'Summer' ELSE 'Fall' END AS season FROM range(1, 13) AS t(m)""",
    "alldays": """
        SELECT CAST(unnest(generate_series(day0, horizon, INTERVAL 1 DAY)) AS DATE) AS d FROM cal0""",
    "promo_day": """
        SELECT d, campaign_key, discount_depth, pct FROM (
            SELECT a.d, p.campaign_key, p.discount_depth, p.pct,
                   ROW_NUMBER() OVER (PARTITION BY a.d ORDER BY p.pct DESC, p.campaign_key) AS k
            FROM (SELECT CAST(unnest(generate_series(MIN(start_date), MAX(end_date), INTERVAL 1 DAY)) AS DATE) AS d
                  FROM promo) a
            JOIN promo p ON a.d BETWEEN p.start_date AND p.end_date) WHERE k = 1""",
    "feasts": """
        SELECT * FROM (
            SELECT make_date(y, 1, 1) AS d, 'New Year''s Day' AS holiday_name FROM feast_years
            UNION ALL SELECT CAST(make_date(y, 5, 31) - CAST((isodow(make_date(y, 5, 31)) - 1) AS INTEGER) AS DATE),
                'Memorial Day' FROM feast_years
            UNION ALL SELECT make_date(y, 7, 4), 'Independence Day' FROM feast_years
            UNION ALL SELECT CAST(make_date(y, 9, 1) + CAST((8 - isodow(make_date(y, 9, 1))) % 7 AS INTEGER) AS DATE),
                'Labor Day' FROM feast_years
            UNION ALL SELECT CAST(make_date(y, 11, 22) + CAST((11 - isodow(make_date(y, 11, 22))) % 7 AS INTEGER) AS DATE),
                'Thanksgiving' FROM feast_years
            UNION ALL SELECT CAST(make_date(y, 11, 23) + CAST((11 - isodow(make_date(y, 11, 22))) % 7 AS INTEGER) AS DATE),
                'Black Friday' FROM feast_years
            UNION ALL SELECT make_date(y, 12, 25), 'Christmas Day' FROM feast_years)""",
    "feast_years": """
        SELECT CAST(unnest(range(year(day0), year(horizon) + 1)) AS INTEGER) AS y FROM cal0""",
    "spine": """
        SELECT w.cust, w.signup,
               CAST(last_day(unnest(generate_series(date_trunc('month', w.signup),
                    date_trunc('month', (SELECT horizon FROM span)), INTERVAL 1 MONTH))) AS DATE) AS me
        FROM who w""",
    "snap_orders": """
        SELECT s.cust, s.me, COUNT(h.ord) AS n, SUM(h.net) AS net, MAX(h.day) AS last_day, MIN(h.day) AS first_day,
               COUNT(h.ord) FILTER (WHERE h.day > s.me - 30) AS n30,
               COUNT(h.ord) FILTER (WHERE h.day > s.me - 90) AS n90,
               SUM(h.net) FILTER (WHERE h.day >= date_trunc('month', s.me) - INTERVAL 11 MONTH) AS net12
        FROM spine s LEFT JOIN hdr h ON h.cust = s.cust AND h.day <= s.me GROUP BY ALL""",
    "snap_back": """
        SELECT s.cust, s.me, SUM(b.refund) AS refund,
               SUM(b.refund) FILTER (WHERE b.rday >= date_trunc('month', s.me) - INTERVAL 11 MONTH) AS refund12
        FROM spine s JOIN back b ON b.cust = s.cust AND b.rday <= s.me GROUP BY ALL""",
    "snap": """
        SELECT s.cust, s.me, date_diff('day', s.signup, s.me) AS age_days, o.n,
               date_diff('month', date_trunc('month', o.first_day), date_trunc('month', s.me)) AS msfp,
               date_diff('day', o.last_day, s.me) AS rec, o.n30, o.n90,
               COALESCE(o.net, 0) - COALESCE(b.refund, 0) AS value,
               COALESCE(o.net12, 0) - COALESCE(b.refund12, 0) AS value12
        FROM spine s JOIN snap_orders o ON o.cust = s.cust AND o.me = s.me
        LEFT JOIN snap_back b ON b.cust = s.cust AND b.me = s.me""",
}

_MACRO = re.compile(r"\{(\w+)\(((?:[^{}]|\{[^{}]*\})*)\)\}")


def _split(args: str) -> list[str]:
    parts, depth, cur = [], 0, ""
    for ch in args:
        depth += ch in "([" 
        depth -= ch in ")]"
        if ch == "," and depth == 0:
            parts.append(cur.strip())
            cur = ""
        else:
            cur += ch
    return [*parts, cur.strip()]


def _num(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _round(x: str, digits: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,6)), {digits}) AS DOUBLE)"


_MACROS = {
    "d": lambda x: _num(x),
    "b": lambda x: f"CAST({x} AS BIGINT)",
    "i": lambda x: f"CAST({x} AS INTEGER)",
    "rnd": _round,
    "pct": lambda a, b, digits="1": _round(f"100.0 * {_num(a)} / NULLIF({_num(b)}, 0)", digits),
    "avg": lambda a, b, digits="2": _round(f"{_num(a)} / NULLIF({_num(b)}, 0)", digits),
    "quant": lambda x, p, digits: _round(f"QUANTILE_CONT({_num(x)}, {p})", digits),
    "med": lambda x: f"QUANTILE_CONT({_num(x)}, 0.5)",
}


def expand(text: str) -> str:
    """Write out ``{name(args)}`` shorthands, innermost first."""
    while True:
        found = _MACRO.search(text)
        if not found:
            return text
        name, args = found.groups()
        text = text[: found.start()] + _MACROS[name](*_split(args)) + text[found.end() :]


def assemble(body: str) -> str:
    """Put the shared tables a statement uses in front of it."""
    words = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)")
    needed: set[str] = set()
    todo = [body]
    while todo:
        for w in set(words.findall(todo.pop())):
            if w in TABLES and w not in needed:
                needed.add(w)
                todo.append(TABLES[w])
    done: list[str] = []

    def place(name: str) -> None:
        if name in done:
            return
        for w in set(words.findall(TABLES[name])):
            if w in needed and w != name:
                place(w)
        done.append(name)

    for name in TABLES:
        if name in needed:
            place(name)
    ctes = ",\n".join(f"{n} AS (\n{expand(TABLES[n]).strip()}\n)" for n in done)
    return (f"WITH {ctes}\n" if ctes else "") + expand(body).strip()


def statements() -> dict[str, str]:
    from oracles import jobs, reports, verdicts

    return {k: assemble(v) for k, v in {**reports.SQL, **jobs.SQL, **verdicts.SQL}.items()}
