"""The oracle's view of the feeds: common table expressions over the same tables.

Written independently of the Spark code. Expressions that nobody refers to are not evaluated.
"""

from __future__ import annotations


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding on the shortest decimal form of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def steady(expr: str, digits: int) -> str:
    """The same after a first rounding at 9 places, for means and sums."""
    return f"CAST(round(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), 9), {digits}) AS DOUBLE)"


def _s(expr: str, digits: int = 2) -> str:
    return steady(f"({expr})", digits)


def _r(expr: str, digits: int = 2) -> str:
    return rounded(f"({expr})", digits)


def ratio(num: str, den: str, digits: int = 2) -> str:
    return f"CASE WHEN {den} > 0 THEN {_r(f'{num} / {den}', digits)} ELSE 0.0 END"


def modulo(days: str, span: int = 15) -> str:
    return f"((({days}) % {span}) + {span}) % {span}"


_TRANSIT = modulo("CAST(l_shipdate AS DATE) - order_day")

CTES = {
    "places": """SELECT n_nationkey, n_name, r_name AS company_id,
        r_name || '_' || (n_nationkey % 2) AS factory_id
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "line_days": """SELECT lineitem.*, o_custkey, CAST(o_orderdate AS DATE) AS order_day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "mkt": f"""SELECT date, a AS steel_price_egypt_egp, b AS iron_ore_price_usd, c AS scrap_price_usd,
        d AS usd_egp_rate, e AS natural_gas_price_usd, f AS brent_oil_usd, g AS electricity_price_egp_kwh,
        h AS seasonality_index, CAST(month(date) = 3 AS INTEGER) AS is_ramadan,
        'MARKET' AS company_id, 'ALL_FACTORIES' AS factory_id
        FROM (SELECT order_day AS date,
            {_r('avg(l_extendedprice / l_quantity)', 9)} AS a, {_r('avg(p_retailprice)', 9)} AS b,
            {_r('avg(CAST(p_size AS DOUBLE))', 9)} AS c, {_r('avg(l_tax) + 1', 9)} AS d,
            {_r('avg(l_quantity)', 9)} AS e, {_r('max(l_extendedprice / l_quantity) / 1001', 9)} AS f,
            {_r('avg(l_discount) + 1', 9)} AS g, {_r('avg(l_tax)', 9)} AS h
            FROM line_days JOIN part ON l_partkey = p_partkey GROUP BY order_day) AS m""",
    "prod": """SELECT company_id, factory_id,
        l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS batch_id,
        CAST(l_shipdate AS DATE) AS date, n_name AS facility, s_name AS production_line, l_linestatus AS line_type,
        CASE WHEN l_linestatus = 'O' THEN 'rebar_' || (l_linenumber * 2 + 6) || 'mm' ELSE 'coil' END AS product_type,
        CASE l_returnflag WHEN 'A' THEN 'morning' WHEN 'N' THEN 'afternoon' ELSE 'night' END AS shift,
        CAST(45 AS DOUBLE) AS planned_tons, greatest(l_quantity - 2, 0.0) AS actual_tons,
        greatest(l_quantity - 2, 0.0) * abs(l_discount) AS waste_tons, abs(l_discount) * 100 AS yield_loss_pct,
        l_quantity / 45 * 100 AS efficiency_pct, l_extendedprice / 100 AS energy_kwh,
        l_extendedprice / 1000 AS natural_gas_m3, CAST(10 AS DOUBLE) - l_tax * 50 AS quality_score,
        CASE WHEN l_quantity <= 2 THEN 'maintenance' ELSE 'running' END AS status
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN places ON s_nationkey = n_nationkey""",
    "ord": f"""SELECT company_id, factory_id, CAST(o_orderkey AS VARCHAR) AS order_id,
        CAST(o_orderdate AS DATE) AS order_date, CAST(o_custkey AS VARCHAR) AS customer_id,
        c_mktsegment AS customer_type, o_orderpriority AS product_type, quantity_tons,
        o_totalprice / quantity_tons AS price_per_ton_egp, o_totalprice AS total_value_egp,
        n_name AS delivery_governorate, CAST(o_orderdate AS DATE) + 7 AS expected_delivery,
        CAST(o_orderdate AS DATE) + CAST(7 + delay AS INTEGER) AS actual_delivery, CAST(delay AS INTEGER) AS delay_days,
        CAST(delay > 0 AS INTEGER) AS is_delayed,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
        CASE WHEN n_nationkey < 5 THEN 'North' WHEN n_nationkey < 10 THEN 'South' WHEN n_nationkey < 15 THEN 'East'
             WHEN n_nationkey < 20 THEN 'West' ELSE 'Other' END AS region
        FROM (SELECT orders.*, quantity_tons,
                {modulo('CAST(first_ship AS DATE) - CAST(o_orderdate AS DATE)')} - 2 AS delay
              FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS quantity_tons, min(l_shipdate) AS first_ship
                                     FROM lineitem GROUP BY l_orderkey) AS l ON o_orderkey = l_orderkey) AS o
        JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey""",
    "ship": f"""SELECT company_id, factory_id,
        l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS shipment_id,
        CAST(l_orderkey AS VARCHAR) AS order_id, factory_id AS origin, n_name AS destination,
        p_size * 20 AS distance_km, CASE WHEN l_linestatus = 'F' THEN 'truck' ELSE 'rail' END AS transport_mode,
        CAST(ceil(l_quantity / 25) AS INTEGER) AS num_trucks, l_quantity AS weight_tons,
        l_extendedprice / 10 AS transport_cost_egp,
        l_extendedprice / 10 / (p_size * 20 * l_quantity) AS cost_per_ton_km_egp,
        CAST(p_size * 20 * CAST(ceil(l_quantity / 25) AS INTEGER) AS DOUBLE) * CAST(0.35 AS DOUBLE) AS fuel_liters,
        CAST(p_size * 20 * CAST(ceil(l_quantity / 25) AS INTEGER) AS DOUBLE) * CAST(0.35 AS DOUBLE)
            * CAST(2.68 AS DOUBLE) AS co2_emissions_kg,
        order_day AS departure_date, order_day + CAST({_TRANSIT} AS INTEGER) AS arrival_date,
        CAST({_TRANSIT} - 4 AS INTEGER) AS delay_days, 'delivered' AS status, 'CARRIER_' || (l_suppkey % 8) AS carrier
        FROM line_days JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
        JOIN places ON c_nationkey = n_nationkey""",
    "purch": f"""SELECT company_id, factory_id,
        l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS purchase_id,
        p_type AS material_type, s_name AS supplier_name, n_name AS origin_country, l_quantity AS quantity_tons,
        CAST(100 + p_size * (s_nationkey % 4) AS DOUBLE) AS price_per_ton_usd,
        l_tax * 100 AS ocean_freight_usd_per_ton,
        l_quantity * (CAST(100 + p_size * (s_nationkey % 4) AS DOUBLE) + l_tax * 100) AS total_landed_cost_usd,
        order_day AS purchase_date, order_day + 7 AS expected_delivery,
        order_day + CAST({_TRANSIT} AS INTEGER) AS actual_delivery,
        CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' ELSE 'C' END AS quality_grade,
        CAST({_TRANSIT} <= 7 AS INTEGER) AS on_time, CAST(1 AS DOUBLE) - abs(l_discount) AS supplier_reliability
        FROM line_days JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN places ON s_nationkey = n_nationkey""",
    "ev": "SELECT events.*, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    # cleaned layer
    "mkt_chg": """SELECT *, CAST(year(date) AS INTEGER) AS year, lag(steel_price_egypt_egp) OVER (
        PARTITION BY company_id, factory_id, year(date) ORDER BY date) AS prev FROM mkt WHERE date IS NOT NULL""",
    "mkt_c": f"""SELECT * EXCLUDE (prev), CAST(abs(price_change_pct) > 2.0 AS INTEGER) AS is_price_spike FROM (
        SELECT *, CASE WHEN prev IS NULL THEN 0.0
                ELSE {_r('(steel_price_egypt_egp - prev) / prev * 100', 4)} END AS price_change_pct,
            {_r('avg(steel_price_egypt_egp) OVER w7')} AS moving_avg_7d,
            {_r('avg(steel_price_egypt_egp) OVER w30')} AS moving_avg_30d,
            {_r('stddev_samp(steel_price_egypt_egp) OVER w7')} AS price_volatility_7d,
            {_r('iron_ore_price_usd * usd_egp_rate')} AS iron_ore_price_egp,
            {_r('scrap_price_usd * usd_egp_rate')} AS scrap_price_egp
        FROM mkt_chg
        WINDOW w7 AS (PARTITION BY company_id, factory_id, year ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w30 AS (PARTITION BY company_id, factory_id, year ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
        ) AS m""",
    "prod_c": f"""SELECT prod.*, {_r('actual_tons - waste_tons')} AS net_output_tons,
        {ratio('energy_kwh', 'actual_tons')} AS energy_per_ton, {ratio('natural_gas_m3', 'actual_tons')} AS gas_per_ton,
        {_r('energy_kwh * coalesce(electricity_price_egp_kwh, CAST(3.5 AS DOUBLE)) + natural_gas_m3 * '
            'coalesce(natural_gas_price_usd, CAST(3 AS DOUBLE)) * coalesce(usd_egp_rate, CAST(50 AS DOUBLE))')}
            AS estimated_energy_cost_egp,
        CASE shift WHEN 'morning' THEN 1 WHEN 'afternoon' THEN 2 WHEN 'night' THEN 3 ELSE 4 END AS shift_rank,
        CAST(coalesce(efficiency_pct < 70, FALSE) AS INTEGER) AS is_underperforming
        FROM prod LEFT JOIN (SELECT date, electricity_price_egp_kwh, natural_gas_price_usd, usd_egp_rate FROM mkt) AS m
        USING (date)""",
    "ord_c": """SELECT ord.*, steel_price_egypt_egp AS steel_price_at_order, usd_egp_rate AS usd_rate_at_order,
        CAST(coalesce(quantity_tons >= 100, FALSE) AS INTEGER) AS is_large_order,
        CAST(CASE WHEN status = 'cancelled' THEN 0 WHEN delay_days <= 0 THEN 100 WHEN delay_days <= 2 THEN 80
             WHEN delay_days <= 5 THEN 60 WHEN delay_days <= 10 THEN 40 ELSE 20 END AS DOUBLE)
             AS delivery_performance_score,
        CAST(month(order_date) AS INTEGER) AS order_month, CAST(quarter(order_date) AS INTEGER) AS order_quarter,
        CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_day_of_week
        FROM ord LEFT JOIN (SELECT date, steel_price_egypt_egp, usd_egp_rate FROM mkt) AS m ON order_date = date""",
    "ship_c": f"""SELECT ship.*, {ratio('transport_cost_egp', 'weight_tons')} AS cost_per_ton,
        CAST(arrival_date - departure_date AS INTEGER) AS transit_days,
        CASE WHEN arrival_date - departure_date > 0
             THEN {_r('CAST(distance_km AS DOUBLE) / (arrival_date - departure_date)')}
             ELSE CAST(distance_km AS DOUBLE) END AS delivery_speed_km_per_day,
        {ratio('fuel_liters', 'weight_tons')} AS fuel_per_ton, {ratio('co2_emissions_kg', 'weight_tons')} AS co2_per_ton,
        CAST(coalesce(cost_per_ton_km_egp <= 3.5, FALSE) AS INTEGER) AS is_efficient FROM ship""",
    "purch_c": f"""SELECT purch.*, usd_egp_rate AS usd_rate_at_purchase,
        {_r('total_landed_cost_usd * coalesce(usd_egp_rate, CAST(50 AS DOUBLE))')} AS total_landed_cost_egp,
        {_r('price_per_ton_usd * coalesce(usd_egp_rate, CAST(50 AS DOUBLE))')} AS price_per_ton_egp,
        CAST(coalesce(actual_delivery - expected_delivery, 0) AS INTEGER) AS days_late,
        CAST(coalesce(actual_delivery - purchase_date, 0) AS INTEGER) AS lead_time_days
        FROM purch LEFT JOIN (SELECT date, usd_egp_rate FROM mkt) AS m ON purchase_date = date""",
    # marts
    "d_prod": """SELECT company_id, factory_id, date, sum(actual_tons) AS total_production_tons,
        avg(efficiency_pct) AS avg_efficiency, sum(waste_tons) AS total_waste_tons, sum(energy_kwh) AS total_energy_kwh,
        count(*) FILTER (efficiency_pct < 70) AS underperforming_batches FROM prod GROUP BY ALL""",
    "d_ord": f"""SELECT company_id, factory_id, order_date AS date, count(order_id) AS total_orders,
        sum(quantity_tons) AS total_order_tons, sum(total_value_egp) AS total_revenue_egp,
        avg(quantity_tons) AS avg_order_size_tons,
        {_r("count(*) FILTER (status = 'delivered') / CAST(count(order_id) AS DOUBLE) * 100")} AS on_time_delivery_pct,
        count(*) FILTER (status IN ('cancelled', 'Cancelled')) AS cancelled_orders_daily
        FROM ord GROUP BY company_id, factory_id, order_date""",
    "d_ship": """SELECT company_id, factory_id, departure_date AS date, count(shipment_id) AS total_shipments,
        sum(transport_cost_egp) AS total_logistics_cost_egp, sum(co2_emissions_kg) AS total_co2_kg,
        sum(fuel_liters) AS total_fuel_liters, avg(cost_per_ton_km_egp) AS avg_cost_per_ton_km
        FROM ship GROUP BY company_id, factory_id, departure_date""",
    "kpi": f"""SELECT p.company_id, p.factory_id, p.date, total_production_tons, avg_efficiency, total_waste_tons,
        total_orders, cancelled_orders_daily, total_revenue_egp, avg_order_size_tons, on_time_delivery_pct,
        steel_price_egypt_egp AS steel_price_egp, usd_egp_rate, total_shipments, total_logistics_cost_egp, total_co2_kg,
        CAST(year(p.date) AS INTEGER) AS year,
        {_r('coalesce(total_revenue_egp, 0) - coalesce(total_production_tons, 0) * coalesce(steel_price_egypt_egp, '
            'CAST(1000 AS DOUBLE)) * CAST(0.6 AS DOUBLE) - coalesce(total_logistics_cost_egp, 0) '
            '- greatest(total_waste_tons, 0) * 200')} AS profit_estimate_egp
        FROM d_prod AS p
        LEFT JOIN d_ord AS o ON p.company_id = o.company_id AND p.factory_id = o.factory_id AND p.date = o.date
        LEFT JOIN d_ship AS s ON p.company_id = s.company_id AND p.factory_id = s.factory_id AND p.date = s.date
        LEFT JOIN mkt AS m ON p.date = m.date""",
    "mon_t": f"""SELECT *, {_r('CASE WHEN total_revenue_egp > 0 THEN (total_revenue_egp - total_production_tons '
            '* avg_steel_price_egp * CAST(0.6 AS DOUBLE) - total_logistics_cost_egp) / total_revenue_egp * 100 '
            'ELSE 0.0 END')} AS gross_margin_pct
        FROM (SELECT company_id, factory_id, make_date(year(date), month(date), 1) AS month_start,
            CAST(year(date) AS INTEGER) AS year_val, CAST(month(date) AS INTEGER) AS month_val, sum(total_production_tons) AS total_production_tons,
            sum(total_revenue_egp) AS total_revenue_egp, CAST(sum(total_orders) AS BIGINT) AS total_orders,
            CAST(sum(cancelled_orders_daily) AS BIGINT) AS cancelled_orders,
            sum(total_logistics_cost_egp) AS total_logistics_cost_egp, avg(avg_efficiency) AS avg_efficiency,
            sum(total_co2_kg) AS total_co2_kg, avg(steel_price_egp) AS avg_steel_price_egp,
            avg(usd_egp_rate) AS avg_usd_rate FROM kpi GROUP BY ALL) AS t""",
    "lead_p": """SELECT * FROM (SELECT company_id, factory_id, CAST(year(order_date) AS INTEGER) AS year_val,
            CAST(month(order_date) AS INTEGER) AS month_val, product_type AS top_product, row_number() OVER (
            PARTITION BY company_id, factory_id, year(order_date), month(order_date)
            ORDER BY count(*) DESC, product_type) AS rn
        FROM ord GROUP BY company_id, factory_id, year(order_date), month(order_date), product_type) AS x
        WHERE rn = 1""",
    "lead_g": f"""SELECT * FROM (SELECT company_id, factory_id, CAST(year(order_date) AS INTEGER) AS year_val,
            CAST(month(order_date) AS INTEGER) AS month_val, delivery_governorate AS top_governorate, row_number() OVER (
            PARTITION BY company_id, factory_id, year(order_date), month(order_date)
            ORDER BY {_r('sum(total_value_egp)')} DESC NULLS LAST, delivery_governorate) AS rn
        FROM ord GROUP BY company_id, factory_id, year(order_date), month(order_date), delivery_governorate) AS x
        WHERE rn = 1""",
    "mon": """SELECT t.company_id, t.factory_id, month_start, t.year_val, t.month_val, total_production_tons,
        total_revenue_egp, total_orders, cancelled_orders, gross_margin_pct, avg_efficiency, total_co2_kg,
        avg_steel_price_egp, avg_usd_rate, top_product, top_governorate
        FROM mon_t AS t
        LEFT JOIN lead_p AS p ON t.company_id = p.company_id AND t.factory_id = p.factory_id
            AND t.year_val = p.year_val AND t.month_val = p.month_val
        LEFT JOIN lead_g AS g ON t.company_id = g.company_id AND t.factory_id = g.factory_id
            AND t.year_val = g.year_val AND t.month_val = g.month_val""",
    "sup_t": f"""SELECT company_id, factory_id, supplier_name, origin_country, material_type,
        count(purchase_id) AS total_purchases, sum(quantity_tons) AS total_quantity_tons,
        avg(price_per_ton_usd) AS avg_price_per_ton_usd, avg(lead_time_days) AS avg_lead_time_days,
        {_r('count(*) FILTER (on_time = 1) / CAST(count(purchase_id) AS DOUBLE) * 100')} AS on_time_pct,
        avg(supplier_reliability) AS avg_reliability, stddev_samp(price_per_ton_usd) AS price_volatility
        FROM purch_c GROUP BY company_id, factory_id, supplier_name, origin_country, material_type""",
    "sup": f"""SELECT *, avg_reliability AS avg_quality_grade, {_r(
            'CASE WHEN on_time_pct >= 80 THEN 10 WHEN on_time_pct >= 50 THEN 20 ELSE 40 END + '
            + _s('greatest(avg_reliability, 0) * 3')
            + ' + CASE WHEN price_volatility IS NULL THEN 15 WHEN price_volatility <= 5 THEN 10 '
            'WHEN price_volatility <= 15 THEN 20 WHEN price_volatility <= 30 THEN 30 ELSE 45 END')} AS risk_score
        FROM sup_t""",
    "pairs": """SELECT o.*, s.transport_cost_egp FROM ord AS o LEFT JOIN ship AS s ON o.company_id = s.company_id
        AND o.factory_id = s.factory_id AND o.order_id = s.order_id""",
    "reg": f"""SELECT company_id, factory_id, delivery_governorate AS governorate, region,
        count(DISTINCT order_id) AS total_orders, sum(quantity_tons) AS total_quantity_tons,
        sum(total_value_egp) AS total_revenue_egp, avg(quantity_tons) AS avg_order_size_tons,
        avg(delay_days) AS avg_delivery_days,
        {_r('count(*) FILTER (delay_days > 0) / CAST(count(DISTINCT order_id) AS DOUBLE) * 100')} AS delay_pct,
        first(product_type ORDER BY order_date, order_id) AS top_product,
        first(customer_type ORDER BY order_date, order_id) AS top_customer_type,
        avg(transport_cost_egp) AS avg_transport_cost_egp
        FROM pairs GROUP BY company_id, factory_id, delivery_governorate, region""",
    "shift_m": """SELECT company_id, factory_id, production_line, shift, avg(efficiency_pct) AS avg_eff_shift
        FROM prod GROUP BY company_id, factory_id, production_line, shift""",
    "shift_bw": """SELECT company_id, factory_id, production_line,
        first(shift ORDER BY round(avg_eff_shift, 9) DESC NULLS LAST, shift) AS best_shift,
        first(shift ORDER BY round(avg_eff_shift, 9) ASC NULLS FIRST, shift) AS worst_shift
        FROM shift_m GROUP BY company_id, factory_id, production_line""",
    "line_t": f"""SELECT company_id, factory_id, production_line, facility, line_type,
        sum(actual_tons) AS total_output_tons, avg(efficiency_pct) AS avg_efficiency,
        avg(yield_loss_pct) AS avg_waste_pct, avg(waste_tons) AS avg_waste_tons,
        avg(quality_score) AS avg_quality_score,
        avg(CASE WHEN actual_tons > 0 THEN energy_kwh / actual_tons END) AS energy_per_ton_kwh,
        avg(CASE WHEN actual_tons > 0 THEN natural_gas_m3 / actual_tons END) AS gas_per_ton_m3,
        count(batch_id) AS total_batches,
        {_r("count(*) FILTER (status IN ('maintenance', 'power_outage')) / CAST(count(batch_id) AS DOUBLE) * 100")}
            AS downtime_pct
        FROM prod GROUP BY company_id, factory_id, production_line, facility, line_type""",
    "line": """SELECT t.* EXCLUDE (avg_waste_tons), best_shift, worst_shift FROM line_t AS t LEFT JOIN shift_bw AS s
        ON t.company_id = s.company_id AND t.factory_id = s.factory_id AND t.production_line = s.production_line""",
    "feat": f"""SELECT date, steel_price_egypt_egp AS steel_price_egp, iron_ore_price_usd, scrap_price_usd, usd_egp_rate,
        natural_gas_price_usd, brent_oil_usd, electricity_price_egp_kwh, seasonality_index, is_ramadan,
        price_change_pct,
        lag(steel_price_egypt_egp, 1) OVER w AS price_lag_1d, lag(steel_price_egypt_egp, 7) OVER w AS price_lag_7d,
        lag(steel_price_egypt_egp, 14) OVER w AS price_lag_14d, lag(steel_price_egypt_egp, 30) OVER w AS price_lag_30d,
        avg(steel_price_egypt_egp) OVER (ORDER BY date ROWS 6 PRECEDING) AS moving_avg_7d,
        avg(steel_price_egypt_egp) OVER (ORDER BY date ROWS 13 PRECEDING) AS moving_avg_14d,
        avg(steel_price_egypt_egp) OVER (ORDER BY date ROWS 29 PRECEDING) AS moving_avg_30d,
        {_r('stddev_samp(steel_price_egypt_egp) OVER (ORDER BY date ROWS 6 PRECEDING)')} AS price_volatility_7d,
        {_r('stddev_samp(steel_price_egypt_egp) OVER (ORDER BY date ROWS 29 PRECEDING)')} AS price_volatility_30d,
        {_r('(iron_ore_price_usd - lag(iron_ore_price_usd) OVER w) / lag(iron_ore_price_usd) OVER w * 100', 4)}
            AS iron_ore_change_pct,
        {_r('(usd_egp_rate - lag(usd_egp_rate) OVER w) / lag(usd_egp_rate) OVER w * 100', 4)} AS usd_change_pct,
        {_r('(brent_oil_usd - lag(brent_oil_usd) OVER w) / lag(brent_oil_usd) OVER w * 100', 4)} AS oil_change_pct,
        CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month_val, CAST(quarter(date) AS INTEGER) AS quarter_val, year
        FROM mkt_c WINDOW w AS (ORDER BY date)""",
    # model features
    "wk": f"""SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start, product_type, region,
        {_s('sum(quantity_tons)')} AS weekly_demand_tons, count(*) AS weekly_order_count,
        {_s('avg(price_per_ton_egp)')} AS avg_price_per_ton, {_s('sum(total_value_egp)')} AS weekly_revenue
        FROM ord WHERE status <> 'cancelled' GROUP BY 1, 2, 3""",
    "wk_mkt": f"""SELECT CAST(date_trunc('week', date) AS DATE) AS week_start,
        {_s('avg(steel_price_egypt_egp)')} AS avg_steel_price, {_s('avg(usd_egp_rate)')} AS avg_usd_rate,
        {_s('avg(iron_ore_price_usd)')} AS avg_iron_ore, {_s('avg(brent_oil_usd)')} AS avg_oil_price,
        {_s('avg(seasonality_index)', 4)} AS avg_seasonality, max(is_ramadan) AS is_ramadan FROM mkt GROUP BY 1""",
    "wk_h": f"""SELECT *, CAST(weekofyear(week_start) AS INTEGER) AS week_of_year, CAST(month(week_start) AS INTEGER) AS month_val,
        CAST(quarter(week_start) AS INTEGER) AS quarter_val, CAST(year(week_start) AS INTEGER) AS year_val,
        lag(weekly_demand_tons, 1) OVER w AS demand_lag_1w, lag(weekly_demand_tons, 2) OVER w AS demand_lag_2w,
        lag(weekly_demand_tons, 3) OVER w AS demand_lag_3w, lag(weekly_demand_tons, 4) OVER w AS demand_lag_4w,
        {_r('avg(weekly_demand_tons) OVER (PARTITION BY product_type, region ORDER BY week_start ROWS 3 PRECEDING)')}
            AS demand_ma_4w,
        {_r('avg(weekly_demand_tons) OVER (PARTITION BY product_type, region ORDER BY week_start ROWS 7 PRECEDING)')}
            AS demand_ma_8w,
        CAST(row_number() OVER w AS DOUBLE) AS time_idx, ln(1 + weekly_demand_tons) AS log1p_demand
        FROM wk WINDOW w AS (PARTITION BY product_type, region ORDER BY week_start)""",
    "dem": """SELECT * FROM wk_h JOIN wk_mkt USING (week_start) WHERE weekly_demand_tons IS NOT NULL
        AND avg_price_per_ton IS NOT NULL AND weekly_revenue IS NOT NULL AND demand_lag_1w IS NOT NULL
        AND demand_lag_2w IS NOT NULL AND demand_lag_3w IS NOT NULL AND demand_lag_4w IS NOT NULL""",
    "risk": """SELECT *, CASE WHEN risk_points >= 60 THEN 2 WHEN risk_points >= 30 THEN 1 ELSE 0 END AS risk_label
        FROM (SELECT *, is_late * 40 + is_low_quality * 30 + is_expensive * 15
                + CASE WHEN days_late > 7 THEN 15 ELSE days_late * 2 END AS risk_points
            FROM (SELECT purch_c.*, CASE quality_grade WHEN 'A' THEN 4.0::DOUBLE WHEN 'B' THEN 3.0::DOUBLE
                    WHEN 'C' THEN 2.0::DOUBLE WHEN 'D' THEN 1.0::DOUBLE ELSE 2.5::DOUBLE END AS quality_num,
                CAST(on_time = 0 AS INTEGER) AS is_late,
                CAST(quality_grade IN ('C', 'D') AS INTEGER) AS is_low_quality,
                CAST(price_per_ton_usd > m AS INTEGER) AS is_expensive
                FROM purch_c JOIN (SELECT material_type AS g, round(avg(price_per_ton_usd), 9) AS m
                                   FROM purch GROUP BY 1) AS a ON material_type = g) AS y) AS x""",
}


def with_feeds(body: str) -> str:
    """The body with the expressions it needs, in dependency order."""
    import re

    needed: set[str] = set()

    def need(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                need(CTES[name])

    need(body)
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed)
    return f"WITH {parts}\n{body}"
