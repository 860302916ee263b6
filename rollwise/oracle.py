"""Independent SQL (DuckDB dialect) for every checked query.

Written from the reports' definitions, not generated from our Spark plans:
feeds are rebuilt from the TPC-H-like views with the fixture mapping, joined,
and aggregated with window functions (``row_number``, ``lag``) where our Spark
code uses ``min(struct)`` and a Spark window. Sums follow the library's rule in
128-bit integers: whole parts and fractions (nano-units, half-up) added apart.
``tests/test_measures.py`` compares the rule itself with unrounded sums.
"""

from __future__ import annotations

from .windows import DateWindow

FLAG = {"blinkit": "A", "instamart": "R", "zepto": "N"}


def xsum(expr: str) -> str:
    x = f"CAST(({expr}) AS DOUBLE)"
    whole = f"SUM(CAST(FLOOR({x}) AS HUGEINT))"
    nano = f"SUM(CAST(FLOOR(({x} - FLOOR({x})) * 1e9 + 0.5) AS HUGEINT))"
    return (f"CAST(CAST({whole} + {nano} // 1000000000 AS BIGINT) AS DOUBLE) "
            f"+ CAST(CAST({nano} % 1000000000 AS BIGINT) AS DOUBLE) / 1e9")


def total(expr: str) -> str:
    return f"COALESCE({xsum(expr)}, 0.0)"


def base(mkt: str) -> str:
    """One row per lineitem of the marketplace with the derived fixture columns."""
    k = "CAST(l.l_partkey AS VARCHAR)"
    return f"""
    SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount,
           o.o_orderstatus, n.n_name,
           'SKU-' || {k} AS sku,
           CASE WHEN l.l_linenumber % 2 = 0 THEN lower('SKU-' || {k}) ELSE 'SKU-' || {k} END AS sku_mixed,
           'org-' || CAST(o.o_custkey % 3 AS VARCHAR) AS org,
           CASE WHEN l.l_partkey % 7 = 0 THEN NULL ELSE 'Item ' || {k} END AS item_name,
           CASE WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_quantity END AS qty,
           l.l_extendedprice / l.l_quantity AS unit_price,
           CAST(date_trunc('week', l.l_shipdate) AS DATE) AS ship_week,
           CAST(date_trunc('week', o.o_orderdate) AS DATE) AS po_week,
           CASE WHEN l.l_linenumber = 4 THEN NULL ELSE 'FeedCat-' || {k} END AS feed_cat,
           CASE WHEN l.l_linenumber = 4 THEN NULL ELSE 'FeedSub-' || {k} END AS feed_sub,
           CASE WHEN l.l_linenumber = 4 THEN NULL ELSE 'FeedBrand-' || {k} END AS feed_brand
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    WHERE l.l_returnflag = '{FLAG[mkt]}'"""


TENANTS = "unnest(['org-0', 'org-1', 'org-2'])"

CITY_MAP = f"""
    SELECT {TENANTS} AS organizationid, n.n_name AS city, r.r_name AS brand_s_choice
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE n.n_nationkey % 6 <> 5"""

CATALOGUE = f"""
    SELECT * FROM (
    SELECT {TENANTS} AS organizationid,
           'SKU-' || CAST(p.p_partkey AS VARCHAR) AS sku_code,
           'PRID-' || CAST(p.p_partkey AS VARCHAR) AS blinkit_prid,
           'IMC-' || CAST(p.p_partkey AS VARCHAR) AS instamart_item_code,
           'INT-' || CAST(p.p_partkey AS VARCHAR) AS brand_internal_sku_code,
           CASE WHEN p.p_partkey % 10 = 3 THEN NULL ELSE p.p_type END AS category,
           p.p_name AS sub__category,
           CASE WHEN p.p_partkey % 10 = 5 THEN NULL ELSE p.p_brand END AS brand,
           CAST(p.p_retailprice AS VARCHAR) AS cogs,
           CASE p.p_partkey % 3 WHEN 0 THEN '5' WHEN 1 THEN '12' ELSE '18' END AS taxes,
           CASE WHEN p.p_partkey % 10 = 4 THEN NULL ELSE CAST(5 + p.p_partkey % 40 AS DOUBLE) END AS margin,
           CAST(p.p_partkey % 2 AS BIGINT) AS active, p.p_partkey
    FROM part p
    WHERE p.p_partkey % 11 <> 7)
    WHERE NOT (organizationid = 'org-2' AND p_partkey % 10 IN (8, 9))"""

PRODUCTID = {"blinkit": "blinkit_prid", "instamart": "instamart_item_code", "zepto": "sku_code"}


def _sku_join(mkt: str, col: str) -> str:
    if mkt == "zepto":
        return f"lower(b.{col}) = lower(scd.sku_code)"
    return f"b.{col} = scd.sku_code"


def _item(mkt: str) -> str:
    return "lower(b.sku_mixed)" if mkt == "zepto" else "b.sku"


def _sku_col(mkt: str) -> str:
    return "sku_mixed" if mkt == "zepto" else "sku"


def _enriched(mkt: str) -> str:
    return f"""
    FROM b
    LEFT JOIN scm ON b.n_name = scm.city AND b.org = scm.organizationid
    LEFT JOIN scd ON {_sku_join(mkt, _sku_col(mkt))} AND b.org = scd.organizationid"""


def _with(mkt: str, *more: str) -> str:
    parts = [f"b AS ({base(mkt)})", f"scm AS ({CITY_MAP})", f"scd AS ({CATALOGUE})", *more]
    return "WITH " + ",\n".join(parts)


def _net(gmv: str, margin: str, tax: str) -> str:
    return f"(({gmv}) * (1 - ({margin}) / 100)) / NULLIF(1 + ({tax}) / 100, 0)"


# ------------------------------------------------------------------ sales
def sales_lines(mkt: str) -> str:
    gmv = "b.l_extendedprice"
    cat = "COALESCE(scd.category, b.feed_cat, 'Unknown')" if mkt == "zepto" else "COALESCE(scd.category, 'Unknown')"
    sub = "COALESCE(scd.sub__category, b.feed_sub, 'Unknown')" if mkt == "zepto" else "COALESCE(scd.sub__category, 'Unknown')"
    brand = "COALESCE(scd.brand, b.feed_brand, 'Unknown')" if mkt == "zepto" else "COALESCE(scd.brand, 'Unknown')"
    m = "COALESCE(scd.margin, 0.0)"
    t = "COALESCE(TRY_CAST(scd.taxes AS DOUBLE), 0.0)"
    return f"""
    SELECT COALESCE(b.org, 'Unknown') AS organizationid, b.ship_week AS reportdate,
           {_item(mkt)} AS itemid, COALESCE(scm.brand_s_choice, 'Unknown') AS brands_choice,
           {cat} AS category, {sub} AS subcategory, {brand} AS brand,
           COALESCE(scd.{PRODUCTID[mkt]}, 'Unknown') AS productid,
           COALESCE(b.item_name, 'Unknown') AS itemname,
           COALESCE(scd.brand_internal_sku_code, 'Unknown') AS brand_internal_sku_code,
           COALESCE(TRY_CAST(scd.cogs AS DOUBLE), 0.0) AS cogs, {m} AS margin, {t} AS tax_rate,
           COALESCE(scd.active, 0) <> 0 AS active,
           COALESCE(b.qty, 0.0) AS qty, COALESCE(b.unit_price, 0.0) AS mrp,
           COALESCE({gmv}, 0.0) AS gmv,
           {_net(f"COALESCE({gmv}, 0.0)", m, t)} AS net,
           {_net(f"COALESCE({gmv}, 0.0)", m, t)} * ({t} / 100) AS taxes_paid
    {_enriched(mkt)}"""


def sales_rollup(lines: str, mkt: str) -> str:
    mrp = "MIN(mrp) AS mrp," if mkt != "blinkit" else ""
    return f"""
    SELECT organizationid, reportdate, itemid, brands_choice,
           MIN(category) AS category, MIN(subcategory) AS subcategory, MIN(brand) AS brand,
           MIN(productid) AS productid, MIN(itemname) AS itemname,
           MIN(brand_internal_sku_code) AS brand_internal_sku_code, MIN(cogs) AS cogs,
           MIN(margin) AS margin, MIN(tax_rate) AS tax_rate, MIN(active) AS active,
           {mrp}
           {xsum('qty')} AS qty, {xsum('gmv')} AS gmv, {xsum('net')} AS net,
           {xsum('taxes_paid')} AS taxes_paid
    FROM {lines}
    GROUP BY organizationid, reportdate, itemid, brands_choice"""


def sales_report(mkt: str) -> str:
    return _with(mkt, f"lines AS ({sales_lines(mkt)})") + sales_rollup("lines", mkt)


def strict_sales(order: list[str]) -> str:
    m, t = "scd.margin", "TRY_CAST(scd.taxes AS DOUBLE)"
    lines = f"""
    SELECT b.sku AS itemid, scm.brand_s_choice AS brands_choice, b.ship_week AS reportdate,
           b.org AS organizationid, scd.blinkit_prid AS productid, b.item_name AS itemname,
           scd.category AS category, scd.sub__category AS subcategory,
           scd.brand_internal_sku_code AS brand_internal_sku_code,
           TRY_CAST(scd.cogs AS DOUBLE) AS cogs, {m} AS margin, {t} AS tax_rate,
           scd.active AS active, scd.brand AS brand, b.qty AS qty,
           b.l_extendedprice / NULLIF(b.qty, 0) AS mrp, b.l_extendedprice AS gmv,
           {_net('b.l_extendedprice', m, t)} AS net,
           {_net('b.l_extendedprice', m, t)} * ({t} / 100) AS taxes_paid
    {_enriched('blinkit')}"""
    aggs = {c: f"MIN({c})" for c in order}
    for c in ("qty", "gmv", "net", "taxes_paid"):
        aggs[c] = xsum(c)
    keys = ["itemid", "brands_choice", "reportdate", "organizationid"]
    sel = ",\n           ".join(c if c in keys else f"{aggs[c]} AS {c}" for c in order)
    return _with("blinkit", f"lines AS ({lines})") + f"""
    SELECT {sel}
    FROM lines GROUP BY {', '.join(keys)}"""


def strict_with_catalogue() -> str:
    """The strict view's sums with the item's catalogue columns looked up anew."""
    return f"""
    SELECT v.organizationid, v.itemid, v.reportdate, v.brands_choice, v.gmv,
           k.category AS category_now, k.brand AS brand_now, k.margin AS margin_now
    FROM ({strict_sales(["itemid", "brands_choice", "reportdate", "organizationid", "gmv"])}) v
    LEFT JOIN ({CATALOGUE}) k ON v.itemid = k.sku_code AND v.organizationid = k.organizationid"""


# -------------------------------------------------------------- dashboards
ORG = "org-1"
WINDOW = DateWindow("1998-02-02", "1998-02-31")
WINDOW_D8 = DateWindow("1998-02-02", "1998-02-20")
WINDOW_D9 = DateWindow("1996-12-02", "1996-12-20")


def _on_report(body: str) -> str:
    return _with("blinkit", f"lines AS ({sales_lines('blinkit')})",
                 f"report AS ({sales_rollup('lines', 'blinkit')})") + body


def _scope(w: DateWindow | None) -> str:
    s = f"WHERE organizationid = '{ORG}'"
    return s + (f" AND {w.sql('reportdate')}" if w else "")


def dashboards() -> dict[str, str]:
    prev = WINDOW.shift_months(-1)

    def d3(w: DateWindow) -> str:
        return _on_report(f"""
    SELECT itemid, COALESCE(MIN(productid), 'productid') AS productid,
           COALESCE(MIN(category), 'Uncategorised') AS category,
           COALESCE(MIN(subcategory), 'Uncategorised') AS subcategory,
           COALESCE(MIN(itemname), 'Unknown') AS itemname,
           {total('gmv')} AS mrp, {total('qty')} AS qty, {total('taxes_paid')} AS taxes,
           {total('net')} AS net_sales,
           {total('gmv * COALESCE(margin, 0) / 100.0')} AS platform_margin
    FROM report {_scope(w)} GROUP BY itemid""")

    def d8(w: DateWindow) -> str:
        return _on_report(f"""
    SELECT COALESCE(brands_choice, 'Unknown') AS city, {total('gmv')} AS sales
    FROM report {_scope(w)} GROUP BY 1""")

    def d11(w: DateWindow) -> str:
        return _on_report(f"""
    SELECT reportdate, COALESCE(category, 'Uncategorised') AS category,
           {total('gmv')} AS total_mrp, {total('qty')} AS total_qty, {total('net')} AS net_sales
    FROM report {_scope(w)} GROUP BY 1, 2""")

    return {
        "d1_brand_daily_sales": _on_report(f"""
    SELECT COALESCE(brand, 'Unknown') AS brand, reportdate AS date, {total('gmv')} AS total_sales
    FROM report {_scope(WINDOW)} GROUP BY 1, 2"""),
        "d2_subcategory_list": f"""
    WITH scd AS ({CATALOGUE})
    SELECT DISTINCT sub__category AS subcategory FROM scd WHERE organizationid = '{ORG}'""",
        "d3_item_pnl": d3(WINDOW),
        "d4_item_pnl_previous_month": d3(prev),
        "d5_city_list": _on_report(f"""
    SELECT MIN(brands_choice) AS city FROM report
    WHERE organizationid = '{ORG}' AND brands_choice IS NOT NULL GROUP BY brands_choice"""),
        "d6_city_category_totals": _on_report(f"""
    SELECT COALESCE(brands_choice, 'Unknown') AS city, COALESCE(category, 'Unknown') AS category,
           {total('gmv')} AS total_mrp, {total('qty')} AS total_qty
    FROM report {_scope(WINDOW)} GROUP BY 1, 2"""),
        "d7_city_category_daily": _on_report(f"""
    SELECT COALESCE(brands_choice, 'Unknown') AS city, COALESCE(category, 'Unknown') AS category,
           reportdate, {total('gmv')} AS total_mrp
    FROM report {_scope(WINDOW)} GROUP BY 1, 2, 3"""),
        "d8_city_sales": d8(WINDOW_D8),
        "d9_city_sales_comparison": d8(WINDOW_D9),
        "d10_item_sales": _on_report(f"""
    SELECT itemid, MIN(productid) AS productid, COALESCE(MIN(itemname), 'Unknown') AS itemname,
           {total('gmv')} AS sales
    FROM report {_scope(WINDOW_D8)} GROUP BY itemid"""),
        "d11_daily_category_totals": d11(WINDOW),
        "d12_daily_category_totals_previous_month": d11(prev),
        "d13_daily_target": f"""
    WITH tg AS (
      SELECT 'org-' || CAST(o_custkey % 3 AS VARCHAR) AS organizationid,
             CASE WHEN o_orderkey % 4 = 0 THEN 'zepto' ELSE 'blinkit' END AS platformid,
             o_orderdate AS date, o_totalprice AS totaltarget
      FROM orders)
    SELECT CAST(date AS DATE) AS date, MIN(totaltarget) AS target FROM tg
    WHERE organizationid = '{ORG}' AND platformid = 'blinkit'
      AND CAST(date AS DATE) BETWEEN DATE '{WINDOW.start}' AND DATE '{WINDOW.end}'
    GROUP BY 1""",
    }


# -------------------------------------------------------------- inventory
def inventory_report(mkt: str) -> str:
    stock = "CAST(FLOOR(b.l_extendedprice / 100) AS DOUBLE)"
    if mkt == "blinkit":
        front, total, pid = "COALESCE(b.qty, 0.0)", f"COALESCE(b.qty, 0.0) + {stock}", "COALESCE(scd.blinkit_prid, '')"
    else:
        front, total = "0.0", stock
        pid = f"COALESCE(scd.{PRODUCTID[mkt]}, 'Unknown')"
    cat = "COALESCE(scd.category, b.feed_cat, 'Unknown')" if mkt == "zepto" else "COALESCE(scd.category, 'Unknown')"
    brand = "COALESCE(scd.brand, b.feed_brand, 'Unknown')" if mkt == "zepto" else "COALESCE(scd.brand, 'Unknown')"
    lines = f"""
    SELECT b.org AS organizationid, {_item(mkt)} AS itemid,
           COALESCE(b.n_name, 'Unknown') AS backendfacilityname, b.ship_week AS reportdate,
           COALESCE(b.item_name, 'Unknown') AS itemname, {pid} AS productid,
           {cat} AS category, COALESCE(scd.sub__category, 'Unknown') AS subcategory, {brand} AS brand,
           COALESCE(scd.brand_internal_sku_code, 'Unknown') AS brand_internal_sku_code,
           COALESCE(scm.brand_s_choice, 'Unknown') AS brands_choice,
           COALESCE(scd.active, 0) <> 0 AS active,
           {total} AS total_quantity, CAST({front} AS DOUBLE) AS frontendinvqty, {stock} AS backendinvqty
    {_enriched(mkt)}"""
    daily = f"""
    SELECT organizationid, itemid, backendfacilityname, reportdate,
           MIN(itemname) AS itemname, MIN(productid) AS productid, MIN(category) AS category,
           MIN(subcategory) AS subcategory, MIN(brand) AS brand,
           MIN(brand_internal_sku_code) AS brand_internal_sku_code, MIN(brands_choice) AS brands_choice,
           MIN(active) AS active,
           {xsum('total_quantity')} AS total_quantity, {xsum('frontendinvqty')} AS frontendinvqty,
           {xsum('backendinvqty')} AS backendinvqty
    FROM lines GROUP BY organizationid, itemid, backendfacilityname, reportdate"""
    return _with(mkt, f"lines AS ({lines})", f"daily AS ({daily})") + """
    SELECT itemid, backendfacilityname, reportdate, itemname, productid, category, subcategory, brand,
           organizationid, brand_internal_sku_code, brands_choice, active,
           total_quantity, frontendinvqty, backendinvqty,
           GREATEST(LAG(backendinvqty, 1, 0.0) OVER w - backendinvqty, 0.0) AS run_rate_backend,
           GREATEST(LAG(total_quantity, 1, 0.0) OVER w - total_quantity, 0.0) AS run_rate_total
    FROM daily
    WINDOW w AS (PARTITION BY organizationid, itemid, backendfacilityname ORDER BY reportdate)"""


# ------------------------------------------------------------ fulfillment
FUL_KEYS = "itemid, ponumber, po_status, brand_internal_sku_code, brands_choice, organizationid, orderdate"
FUL_ORDER = ("backendfacilityname, quantity, grn_quantity, total_amount, fill_rate_sku, mrp, "
             "appointmentdate, expirydate, itemname, productid")


def daily_min_price() -> str:
    return f"""
    WITH b AS ({base('zepto')})
    SELECT lower(b.sku_mixed) AS sku, b.ship_week AS orderdate, MIN(b.unit_price) AS mrp
    FROM b GROUP BY 1, 2"""


def fulfillment_report(mkt: str) -> str:
    ordered = "CASE WHEN b.l_linenumber = 7 THEN 0.0 ELSE b.l_quantity END"
    remaining = "CASE WHEN b.l_linenumber = 7 THEN NULL ELSE CAST(FLOOR(b.l_quantity * b.l_discount * 5) AS DOUBLE) END"
    appointment = "CASE WHEN b.l_linenumber = 6 THEN NULL ELSE b.po_week + b.l_linenumber END"
    expiry = "CASE WHEN b.l_linenumber = 6 THEN NULL ELSE b.po_week + 30 END"
    epoch = "DATE '1970-01-01'"
    po = "'PO-' || CAST(b.l_orderkey AS VARCHAR)"
    if mkt == "zepto":
        grn = f"COALESCE({ordered}, 0.0) - COALESCE({remaining}, 0.0)"
        fill_feed = f"COALESCE(1.0 - COALESCE({remaining}, 0.0) / NULLIF({ordered}, 0.0), 0.0)"
        measures = f"""
           COALESCE(p.mrp, 0.0) AS mrp, COALESCE({appointment}, {epoch}) AS appointmentdate,
           {epoch} AS expirydate, COALESCE(b.n_name, 'Unknown') AS backendfacilityname,
           COALESCE({ordered}, 0.0) AS quantity, COALESCE({grn}, 0.0) AS grn_quantity,
           COALESCE(p.mrp, 0.0) * COALESCE({ordered}, 0.0) AS total_amount,
           COALESCE({fill_feed}, 0.0) AS fill_rate_sku"""
        status = "'Unknown'"
        extra = """
    LEFT JOIN price p ON lower(b.sku_mixed) = p.sku AND b.po_week = p.orderdate"""
    else:
        measures = f"""
           COALESCE(b.unit_price, 0.0) AS mrp, COALESCE({appointment}, {epoch}) AS appointmentdate,
           COALESCE({expiry}, {epoch}) AS expirydate, COALESCE(b.n_name, 'Unknown') AS backendfacilityname,
           COALESCE({ordered}, 0.0) AS quantity,
           COALESCE({ordered}, 0.0) - COALESCE({remaining}, 0.0) AS grn_quantity,
           COALESCE(b.l_extendedprice, 0.0) AS total_amount,
           COALESCE(1.0 - COALESCE({remaining}, 0.0) / NULLIF(COALESCE({ordered}, 0.0), 0.0), 0.0) AS fill_rate_sku"""
        status = "COALESCE(b.o_orderstatus, 'Unknown')"
        extra = ""
    lines = f"""
    SELECT {_item(mkt)} AS itemid, {po} AS ponumber, {status} AS po_status,
           COALESCE(scd.brand_internal_sku_code, 'Unknown') AS brand_internal_sku_code,
           COALESCE(scm.brand_s_choice, 'Unknown') AS brands_choice, b.org AS organizationid,
           b.po_week AS orderdate, COALESCE(b.item_name, 'Unknown') AS itemname,
           COALESCE(scd.{PRODUCTID[mkt]}, 'Unknown') AS productid, {measures}
    {_enriched(mkt)}{extra}"""
    ctes = [f"lines AS ({lines})"]
    if mkt == "zepto":
        price = f"""
    SELECT lower(b.sku_mixed) AS sku, b.ship_week AS orderdate, MIN(b.unit_price) AS mrp
    FROM b GROUP BY 1, 2"""
        ctes.insert(0, f"price AS ({price})")
    return _with(mkt, *ctes) + f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY {FUL_KEYS} ORDER BY {FUL_ORDER}) AS rn FROM lines)
    WHERE rn = 1"""


# ------------------------------------------------------------ jobs' results
def _date(kind: str) -> str:
    return "orderdate" if kind == "fulfillment" else "reportdate"


def inside(report: str, kind: str, w: DateWindow) -> str:
    return f"SELECT * FROM ({report}) WHERE {w.sql(_date(kind))}"


def outside(report: str, kind: str, w: DateWindow) -> str:
    return f"SELECT * FROM ({report}) WHERE NOT ({w.sql(_date(kind))})"


def run_rates(mkt: str) -> str:
    return ("SELECT organizationid, itemid, backendfacilityname, reportdate, backendinvqty, total_quantity, "
            f"run_rate_backend, run_rate_total FROM ({inventory_report(mkt)})")
