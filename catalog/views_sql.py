"""SQL of the domain tables in :mod:`catalog.views`, by name, in dependency order."""

from __future__ import annotations

AS_OF = "DATE '2001-07-01'"


def dec2(x: str) -> str:
    """Half-up decimal of a double, by way of its shortest text."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(18,2))"


def last_year(d: str) -> str:
    """364 days back; one day less before 29 February of a year divisible by 400 and after
    February of the year that follows it."""
    early = f"(year({d}) % 400 = 0 AND dayofyear({d}) < 60)"
    late = f"((year({d}) - 1) % 400 = 0 AND dayofyear({d}) >= 60)"
    return f"(CAST({d} AS DATE) - CASE WHEN {early} OR {late} THEN 363 ELSE 364 END)"


def closed_holiday(d: str) -> str:
    return (
        f"((month({d}) = 11 AND day({d}) BETWEEN 22 AND 28 AND isodow({d}) = 4) "
        f"OR (month({d}) = 12 AND day({d}) = 25))"
    )


def latest(table: str, keys: str, col: str = "generation_date") -> str:
    return (
        f"SELECT * FROM {table} QUALIFY {col} = max({col}) OVER (PARTITION BY {keys})"
    )


HORIZON_DAYS = {"short": (16, 19), "long": (21, 24), "redundancy": (25, 29)}

VIEWS_SQL: dict[str, str] = {}
V = VIEWS_SQL

V["lines"] = """
  SELECT CAST(s_nationkey + 1 AS INTEGER) location_num, CAST(l_partkey % 20 AS INTEGER) product,
    CAST(l_shipdate AS DATE) business_date,
    CAST(l_shipdate AS DATE) + to_minutes((l_orderkey % 96) * 15) timequarter,
    CAST(l_shipdate AS DATE) + CAST(1 + l_linenumber % 2 AS INTEGER) generation_date,
    l_orderkey order_num, CAST(l_extendedprice AS DECIMAL(18,2)) price,
    CAST(l_quantity AS DECIMAL(18,2)) quantity, l_returnflag flag
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


def _sales(keys: str, where: str = "") -> str:
    return f"""
  SELECT location_num, business_date{keys}, generation_date,
    CAST(sum(price) AS DECIMAL(18,2)) sales_sub_total,
    CAST(count(DISTINCT order_num) AS DECIMAL(18,2)) trans_count
  FROM lines {where} GROUP BY location_num, business_date{keys}, generation_date"""


def _items(keys: str, where: str = "") -> str:
    return f"""
  SELECT location_num, product, business_date{keys}, generation_date,
    CAST(sum(quantity) AS DECIMAL(18,2)) sum_daily_quantity
  FROM lines {where} GROUP BY location_num, product, business_date{keys}, generation_date"""


V["sales_daily"] = _sales("")
V["sales_15min"] = _sales(", timequarter")
V["items_daily"] = _items("")
V["items_15min"] = _items(", timequarter")
V["deferred_sales_15min"] = _sales(", timequarter", "WHERE flag = 'R'")
V["deferred_items_15min"] = _items(", timequarter", "WHERE flag = 'R'")
V["latest_sales_daily"] = latest("sales_daily", "location_num, business_date")
V["latest_sales_15min"] = latest("sales_15min", "location_num, timequarter")
V["latest_items_daily"] = latest("items_daily", "location_num, product, business_date")
V["latest_items_15min"] = latest("items_15min", "location_num, product, timequarter")

V["stores"] = "SELECT CAST(n_nationkey + 1 AS INTEGER) location_num FROM nation"
V["saturday_off"] = "SELECT location_num FROM stores WHERE location_num IN (3, 7)"
V["settings"] = """
  SELECT CAST(n_nationkey + 1 AS INTEGER) location_num,
    concat(CAST(4 + n_nationkey % 3 AS VARCHAR), '-week',
      lpad(CAST((n_nationkey % 4) * 10 AS VARCHAR), 2, '0')) naming_conv
  FROM nation WHERE n_nationkey % 5 <> 4"""
V["location_list"] = """
  SELECT location_num, CASE WHEN location_num % 2 = 1 THEN 'LSTM' ELSE 'baseline' END forecast_type
  FROM stores"""
V["locations"] = """
  SELECT location_num,
    CASE kind WHEN 1 THEN d + 10 WHEN 2 THEN d - 30 WHEN 3 THEN d - 60 WHEN 4 THEN d - 100
      ELSE DATE '1901-01-01' END remodelclosedate,
    CASE WHEN kind IN (2, 3, 4) AND location_num <= 16 THEN d - 90 WHEN kind = 1 THEN d + 12
      WHEN kind = 5 THEN d - 5 ELSE DATE '1901-01-01' END remodelprojectedclosedate,
    CASE kind WHEN 1 THEN d + 40 WHEN 2 THEN d + 30 WHEN 3 THEN d - 10 WHEN 4 THEN d - 50
      ELSE DATE '1901-01-01' END remodelreopendate,
    CASE kind WHEN 5 THEN d + 60 ELSE DATE '1901-01-01' END remodelprojectedreopendate,
    d - 1 generation_date
  FROM (SELECT location_num, (location_num - 1) % 6 kind, DATE '2001-07-01' d FROM stores)"""
V["recipe_history"] = """
  SELECT pin, ingredient_id, quantity * share ingredient_quantity,
    CASE WHEN ingredient_id % 2 = 0 THEN 'EA' ELSE 'LB' END unit_of_measure, generation_date
  FROM (SELECT CAST(p_partkey % 20 AS INTEGER) pin, CAST(p_size % 7 AS INTEGER) ingredient_id,
      CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) * 100 AS BIGINT) // (count(*) * 10) / 1e4
        quantity
    FROM part GROUP BY 1, 2),
    (VALUES (DATE '2001-06-30', 1e0), (DATE '2001-05-31', 0.5e0)) v(generation_date, share)"""
V["recipe"] = "SELECT * FROM recipe_history WHERE generation_date = DATE '2001-06-30'"
V["ycf"] = """
  SELECT CAST(s_nationkey + 1 AS INTEGER) location_num,
    CAST(s_suppkey % 7 AS INTEGER) ingredient_id, 0.5e0 + (s_suppkey % 10) / 1e1 ycf,
    CASE WHEN s_suppkey % 4 = 0 THEN DATE '2001-05-31' ELSE DATE '2001-06-30' END generation_date
  FROM supplier"""
V["combinations"] = (
    "SELECT DISTINCT location_num, product FROM items_daily WHERE product % 4 <> 3"
)
V["expected_products"] = (
    "SELECT location_num, CAST(1 + location_num % 3 AS BIGINT) products FROM stores"
)
V["calendar_daily"] = f"""
  SELECT business_date, CAST(isodow(business_date) AS INTEGER) dayofweek,
    CASE WHEN isodow(business_date) = 7 THEN 1 ELSE 0 END sunday,
    CASE WHEN {closed_holiday("business_date")} THEN 1 ELSE 0 END holiday,
    CASE WHEN federalholiday_name <> 'Regular-day' THEN 1 ELSE 0 END federalholiday,
    CASE WHEN month(business_date) = 11 AND day(business_date) BETWEEN 20 AND 30
      THEN 1 ELSE 0 END aroundthanksgiving,
    CASE WHEN month(business_date) = 12 AND day(business_date) BETWEEN 22 AND 28
      THEN 1 ELSE 0 END aroundchristmas,
    CASE WHEN month(business_date) = 12 AND day(business_date) IN (24, 31)
      THEN 1 ELSE 0 END onedaypriorchristmas_and_new_year,
    CASE WHEN month(business_date) = 11 AND day(business_date) BETWEEN 23 AND 29
      AND isodow(business_date) = 5 THEN 1 ELSE 0 END blackfridaycheck,
    federalholiday_name
  FROM (SELECT business_date,
      CASE strftime(business_date, '%m-%d') WHEN '01-01' THEN 'New-Years-Day'
        WHEN '07-04' THEN 'Independence-Day' WHEN '11-11' THEN 'Veterans-Day'
        WHEN '12-25' THEN 'Christmas-Day' ELSE
          CASE WHEN {closed_holiday("business_date")} THEN 'Thanksgiving-Day'
            ELSE 'Regular-day' END END federalholiday_name
    FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) business_date
      FROM (SELECT CAST(min(l_shipdate) AS DATE) a, CAST(max(l_shipdate) AS DATE) + 60 b
        FROM lineitem)))"""
V["time_grid"] = """
  SELECT strftime(TIMESTAMP '2000-01-01' + to_minutes(15 * i), '%H:%M:%S') AS "interval"
  FROM range(96) r(i)"""
V["calendar_15min"] = """
  SELECT business_date, business_date + to_minutes(15 * i) timequarter
  FROM calendar_daily, range(96) r(i)"""
V["ingredients_15min"] = """
  SELECT location_num, business_date, timequarter, ingredient_id, unit_of_measure,
    round(sum(CAST(sum_daily_quantity AS DOUBLE) * r.ingredient_quantity), 4) ingredient_quantity
  FROM items_15min JOIN recipe r ON product = pin GROUP BY ALL"""
V["ingredients_latest"] = """
  SELECT location_num, business_date, timequarter, ingredient_id,
    round(sum(CAST(sum_daily_quantity AS DOUBLE) * ingredient_quantity), 4) used
  FROM latest_items_15min JOIN recipe ON product = pin
  GROUP BY location_num, business_date, timequarter, ingredient_id, unit_of_measure"""
V["prepared_sales_daily"] = (
    "SELECT * FROM latest_sales_daily WHERE business_date <= DATE '2001-10-28'"
)
V["prepared_sales_15min"] = (
    "SELECT * FROM latest_sales_15min WHERE business_date <= DATE '2001-10-28'"
)
V["prepared_items_daily"] = (
    "SELECT * FROM latest_items_daily WHERE business_date <= DATE '2001-10-28'"
)
V["past_sales_daily"] = "SELECT * FROM latest_sales_daily WHERE business_date <= DATE '2001-06-29'"
V["past_items_daily"] = "SELECT * FROM latest_items_daily WHERE business_date <= DATE '2001-06-29'"

V["runs"] = """
  SELECT location_num, unnest([newest, newest - 2]) generation_date
  FROM (SELECT location_num, DATE '2001-07-01' - CASE WHEN location_num % 9 = 0 THEN 1 ELSE 0 END
    newest FROM stores)"""


def _ahead(table: str, horizon: str, columns: str) -> str:
    first, last = HORIZON_DAYS[horizon]
    return f"""
  SELECT t.location_num, t.business_date + 364 business_date, {columns}, runs.generation_date
  FROM {table} t JOIN runs ON t.location_num = runs.location_num
  WHERE t.business_date + 364 BETWEEN runs.generation_date + {first}
    AND runs.generation_date + {last}"""


_TIME = "strftime(timequarter, '%H:%M:%S')"
for _h in HORIZON_DAYS:
    V[f"forecast_sales_{_h}"] = _ahead(
        "latest_sales_daily", _h, "CAST(sales_sub_total AS DOUBLE) forecast"
    )
    V[f"forecast_trans_{_h}"] = _ahead(
        "latest_sales_daily", _h, "CAST(trans_count AS DOUBLE) forecast"
    )
    V[f"forecast_items_{_h}"] = _ahead(
        "latest_items_daily",
        _h,
        "product item_id, CAST(sum_daily_quantity AS DOUBLE) forecast",
    )
    V[f"forecast_15min_{_h}"] = _ahead(
        "latest_sales_15min",
        _h,
        f"{_TIME} interval_start_time, CAST(sales_sub_total AS DOUBLE) forecast, "
        "CAST(trans_count AS DOUBLE) forecast_tx",
    )
    V[f"forecast_items_15min_{_h}"] = _ahead(
        "latest_items_15min",
        _h,
        f"product item_id, {_TIME} interval_start_time, "
        "CAST(sum_daily_quantity AS DOUBLE) forecast",
    )
    V[f"forecast_ingredients_15min_{_h}"] = _ahead(
        "ingredients_latest",
        _h,
        f"ingredient_id, {_TIME} interval_start_time, used forecast",
    )


def _metric_ratios(measure: str) -> str:
    return f"""
  SELECT r.location_num, r.business_date, r.time,
    CASE WHEN runs.generation_date < DATE '2001-06-30' THEN ratio / 2 ELSE ratio END ratio,
    runs.generation_date
  FROM (SELECT q.location_num, q.business_date + 364 business_date, {_TIME} AS time,
      CAST(q.{measure} AS DOUBLE) / CAST(d.{measure} AS DOUBLE) ratio
    FROM latest_sales_15min q JOIN latest_sales_daily d
      ON q.location_num = d.location_num AND q.business_date = d.business_date) r
  JOIN runs ON r.location_num = runs.location_num
  WHERE r.business_date BETWEEN DATE '2001-07-11' AND DATE '2001-08-02'"""


V["sales_ratios"] = _metric_ratios("sales_sub_total")
V["trans_ratios"] = _metric_ratios("trans_count")
V["item_ratios"] = f"""
  SELECT q.location_num, q.product, q.business_date + 364 business_date, {_TIME} AS time,
    CAST(q.sum_daily_quantity AS DOUBLE) / CAST(d.sum_daily_quantity AS DOUBLE) ratio,
    {AS_OF} generation_date
  FROM latest_items_15min q JOIN latest_items_daily d ON q.location_num = d.location_num
    AND q.business_date = d.business_date AND q.product = d.product
  WHERE q.product % 5 <> 0
    AND q.business_date + 364 BETWEEN DATE '2001-07-11' AND DATE '2001-08-02'"""


def _control(table: str, measure: str, mark: int) -> str:
    return f"""
  SELECT * REPLACE (CAST({measure} + CASE WHEN location_num % 6 = {mark} THEN 1 ELSE 0 END
    AS DECIMAL(18,2)) AS {measure}) FROM {table}"""


V["control_sales_daily"] = _control("sales_daily", "sales_sub_total", 5)
V["control_sales_15min"] = _control("sales_15min", "sales_sub_total", 5)
V["control_items_daily"] = _control("items_daily", "sum_daily_quantity", 4)
V["control_items_15min"] = _control("items_15min", "sum_daily_quantity", 4)
V["metric_checks"] = """
  SELECT location_num, generation_date, max(business_date) business_date_max,
    CASE WHEN (location_num + day(generation_date)) % 5 = 0 THEN 0 ELSE 1 END dailyqc
  FROM sales_daily WHERE business_date <= DATE '2001-06-29' GROUP BY 1, 2"""
V["item_checks"] = """
  SELECT location_num, generation_date, max(business_date) business_date_max,
    CASE WHEN (location_num + day(generation_date) * 2) % 7 = 0 THEN 0 ELSE 1 END dailyqc
  FROM items_daily WHERE business_date <= DATE '2001-06-29' GROUP BY 1, 2"""
