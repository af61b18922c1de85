"""Domain tables expressed over the driver tables.

Stores are supplier nations, items are part numbers modulo 20, and facts are
line items; see FIXTURES.md.  ``views_sql`` holds the same definitions as SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.functions.calendar import (
    HORIZONS,
    dow_iso,
    is_closed_holiday,
    quarter_hours,
    time_of_day,
)
from tillcast.functions.numeric import dec2
from tillcast.operators.aggregates import rollup_daily
from tillcast.operators.predicates import NO_DATE
from tillcast.operators.snapshot import dedupe_latest, newest_versions
from tillcast.session import new_path

AS_OF = date(2001, 7, 1)
LAST_PREPARED = date(2001, 10, 28)
STAPLES = tuple(range(10))
STAPLE_ITEM, STAPLE_INGREDIENT = 1, 1

LOC = "location_num"
DAY = "business_date"
GEN = "generation_date"


LINES_PER_TASK = 400_000
NEAR = 3  # days beyond a forecast's own that its facts and documents can meet


def days(n: int) -> date:
    return AS_OF + timedelta(days=n)


def _reach(horizon: str) -> tuple[int, int]:
    """Days ahead of the run date that a horizon covers over all runs, up to three days back."""
    first, last = HORIZONS[horizon]
    return first - 3, last


# Tables already loaded: (application, scale-factor folder, name) -> path and schema.
_LOADED: dict[tuple[str, str, str], tuple] = {}


class Views:
    """DataFrames over one scale-factor folder.

    Facts, their newest versions, the calendar, check tables and document
    parts are stored tables in the pipeline, so they are derived once per
    application and written as Parquet to the shared folder; every query reads
    them from there.  The rest are views over them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._whole, self._prefix, self._cut = self, "", None

    def part(self, name: str, lines: Callable[[], DataFrame]) -> Views:
        """The same facts over some of the lines, stored under names of their own.

        The facts are grouped by store and date at least: a part that has all lines of a
        store and date has its facts as they are over all lines.
        """
        out = type(self)(self.spark, self.sf_dir)
        out._whole, out._prefix, out._cut = self, f"{name}_", lines
        return out

    def stored(self, name: str, build: Callable[[], DataFrame], *order: str) -> DataFrame:
        """The table of that name, derived and written on first use.

        Rows are sorted inside every file, so that row groups cover short
        ranges of stores and dates and can be skipped.
        """
        name = self._prefix + name
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _LOADED:
            df, path = build(), new_path(self.spark, name)
            (df.sortWithinPartitions(*order) if order else df).write.parquet(path)
            _LOADED[key] = (path, df.schema)
        path, schema = _LOADED[key]
        return self.spark.read.schema(schema).parquet(path)

    def versions(self, name: str, facts: DataFrame, *keys: str) -> DataFrame:
        """Control table of a stored table's newest version per key, kept with it."""
        keys = keys or (LOC,)
        stem = "_".join(("versions", name, *keys))
        return self.stored(stem, lambda: newest_versions(facts, list(keys)))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- facts ---------------------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        if self._cut is not None:
            return self._cut()
        day = F.to_date("l_shipdate")
        minutes = F.make_dt_interval(mins=((F.col("l_orderkey") % 96) * 15).cast("int"))
        return (
            self.table("lineitem")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                (F.col("s_nationkey") + 1).cast("int").alias(LOC),
                (F.col("l_partkey") % 20).cast("int").alias("product"),
                day.alias(DAY),
                (day.cast("timestamp_ntz") + minutes).alias("timequarter"),
                F.date_add(day, (F.col("l_linenumber") % 2 + 1).cast("int")).alias(GEN),
                F.col("l_orderkey").alias("order_num"),
                dec2(F.col("l_extendedprice")).alias("price"),
                dec2(F.col("l_quantity")).alias("quantity"),
                F.col("l_returnflag").alias("flag"),
            )
        )

    @cached_property
    def near(self) -> Views:
        """The part that forecasts by quarter-hour and their documents can meet.

        A document compares a date with one 363 to 365 days back, and a quarter-hour lies
        within a day of its date.  Lines without a quarter-hour are versions of one key.
        """
        reaches = [_reach(horizon) for horizon in HORIZONS]
        first = days(min(first for first, _ in reaches) - 364 - NEAR)
        last = days(max(last for _, last in reaches) - 364 + NEAR)
        wanted = F.col(DAY).between(F.lit(first), F.lit(last)) | F.col("timequarter").isNull()
        return self.part("near", lambda: self.lines.where(wanted))

    def recent(self, n: int) -> Views:
        """The part of each store's newest ``n`` dates, and of its newest with a recipe's item.

        The newest dates of the sales, items or ingredients of this part are those of all lines.
        """

        def lines() -> DataFrame:
            dates = self.stored(f"recent_{n}_dates", lambda: self._recent_dates(n))
            dates = dates.select(F.col(LOC).alias("_loc"), F.col(DAY).alias("_day"))
            same = F.col(LOC).eqNullSafe(F.col("_loc")) & F.col(DAY).eqNullSafe(F.col("_day"))
            return self.lines.join(dates, same, "left_semi")

        return self.part(f"recent_{n}", lines)

    def _recent_dates(self, n: int) -> DataFrame:
        pins = self.recipe.select(F.col("pin").alias("product"), F.lit(1).alias("_used")).distinct()
        per_day = (
            self.lines.select(LOC, DAY, "product")
            .join(pins, "product", "left")
            .groupBy(LOC, DAY)
            .agg(F.coalesce(F.max("_used"), F.lit(0)).alias("_used"))
        )
        newest = Window.partitionBy(LOC).orderBy(F.desc(DAY))
        used = F.sum("_used").over(newest.rowsBetween(Window.unboundedPreceding, 0))
        ranked = per_day.withColumns({"_rank": F.row_number().over(newest), "_rank_used": used})
        wanted = (F.col("_rank") <= n) | ((F.col("_used") == 1) & (F.col("_rank_used") <= n))
        return ranked.where(wanted).select(LOC, DAY)

    @cached_property
    def _partitions(self) -> int:
        """Partitions in proportion to the lines: a task's share does not grow with the input."""
        rows = (self.table("lineitem") if self._cut is None else self.lines).count()
        return max(self.spark.sparkContext.defaultParallelism, -(-rows // LINES_PER_TASK))

    def _sales(
        self, lines: DataFrame, *keys: str, parts: int | None = None, deferred: Column | None = None
    ) -> DataFrame:
        """Sales and orders per cell; behind ``_`` those of the deferred lines, and their number."""
        # Orders first, both steps behind one shuffle: a distinct count would take two.
        cell = [LOC, DAY, *keys, GEN]
        per_order = [F.sum("price").alias("price")]
        totals = [
            dec2(F.sum("price")).alias("sales_sub_total"),
            dec2(F.count("order_num")).alias("trans_count"),
        ]
        columns = [*cell, "order_num", "price"]
        if deferred is not None:
            columns.append(deferred.alias("_deferred"))
            per_order += [
                F.sum(F.when(F.col("_deferred"), F.col("price"))).alias("_price"),
                F.count(F.when(F.col("_deferred"), 1)).alias("_lines"),
            ]
            totals += [
                dec2(F.sum("_price")).alias("_sales_sub_total"),
                dec2(F.count(F.when(F.col("_lines") > 0, F.col("order_num")))).alias("_trans_count"),
                F.sum("_lines").alias("_lines"),
            ]
        orders = lines.select(*columns)
        orders = orders.repartition(parts, *cell) if parts else orders.repartition(*cell)
        return orders.groupBy(*cell, "order_num").agg(*per_order).groupBy(*cell).agg(*totals)

    def _items(self, lines: DataFrame, *keys: str, deferred: Column | None = None) -> DataFrame:
        """Quantity per cell; behind ``_`` that of the deferred lines, and their number."""
        totals = [dec2(F.sum("quantity")).alias("sum_daily_quantity")]
        if deferred is not None:
            totals += [
                dec2(F.sum(F.when(deferred, F.col("quantity")))).alias("_sum_daily_quantity"),
                F.count(F.when(deferred, 1)).alias("_lines"),
            ]
        return lines.groupBy(LOC, "product", DAY, *keys, GEN).agg(*totals)

    @cached_property
    def _sales_cells(self) -> DataFrame:
        # All and deferred lines in one pass over the lines.
        return self.stored(
            "sales_cells",
            lambda: self._sales(
                self.lines, "timequarter", parts=self._partitions, deferred=F.col("flag") == "R"
            ),
            LOC,
            DAY,
        )

    @cached_property
    def _item_cells(self) -> DataFrame:
        return self.stored(
            "item_cells",
            lambda: self._items(self.lines, "timequarter", deferred=F.col("flag") == "R"),
            LOC,
            DAY,
        )

    def _all(self, cells: DataFrame) -> DataFrame:
        return cells.select(*[c for c in cells.columns if not c.startswith("_")])

    def _deferred(self, cells: DataFrame) -> DataFrame:
        """Cells with deferred lines, by those lines alone."""
        own = [F.col(f"_{c}").alias(c) if f"_{c}" in cells.columns else c for c in self._all(cells).columns]
        return cells.where("_lines > 0").select(*own)

    @cached_property
    def sales_daily(self) -> DataFrame:
        # An order falls into one quarter-hour, so the day is the sum of its intervals.
        return self.stored(
            "sales_daily",
            lambda: self._rollup(self.sales_15min, ["sales_sub_total", "trans_count"], [LOC, DAY]),
            LOC,
            DAY,
        )

    def _rollup(self, df: DataFrame, measures: list[str], keys: list[str]) -> DataFrame:
        return rollup_daily(df, measures, [*keys, GEN]).withColumns(
            {m: dec2(F.col(m)) for m in measures}
        )

    @cached_property
    def sales_15min(self) -> DataFrame:
        return self._all(self._sales_cells)

    @cached_property
    def items_daily(self) -> DataFrame:
        return self.stored(
            "items_daily",
            lambda: self._rollup(
                self.items_15min, ["sum_daily_quantity"], [LOC, "product", DAY]
            ),
            LOC,
            DAY,
        )

    @cached_property
    def items_15min(self) -> DataFrame:
        return self._all(self._item_cells)

    @cached_property
    def deferred_sales_15min(self) -> DataFrame:
        return self._deferred(self._sales_cells)

    @cached_property
    def deferred_items_15min(self) -> DataFrame:
        return self._deferred(self._item_cells)

    @cached_property
    def latest_sales_daily(self) -> DataFrame:
        return self.stored(
            "latest_sales_daily",
            lambda: dedupe_latest(
                self.sales_daily, [LOC, DAY], ["sales_sub_total", "trans_count"]
            ),
            LOC,
            DAY,
        )

    def _latest_sales(self, facts: DataFrame) -> DataFrame:
        return dedupe_latest(facts, [LOC, "timequarter"], [DAY, "sales_sub_total", "trans_count"])

    def _latest_items(self, facts: DataFrame) -> DataFrame:
        return dedupe_latest(
            facts, [LOC, "product", "timequarter"], [DAY, "sum_daily_quantity"]
        )

    @cached_property
    def latest_sales_15min(self) -> DataFrame:
        return self.stored(
            "latest_sales_15min",
            lambda: self._latest_sales(self.sales_15min),
            LOC,
            DAY,
        )

    @cached_property
    def latest_items_daily(self) -> DataFrame:
        return self.stored(
            "latest_items_daily",
            lambda: dedupe_latest(
                self.items_daily, [LOC, "product", DAY], ["sum_daily_quantity"]
            ),
            LOC,
            DAY,
        )

    @cached_property
    def latest_items_15min(self) -> DataFrame:
        return self.stored(
            "latest_items_15min",
            lambda: self._latest_items(self.items_15min),
            LOC,
            DAY,
        )

    @cached_property
    def ingredients_15min(self) -> DataFrame:
        return self.stored(
            "ingredients_15min",
            lambda: self._ingredients(
                self.items_15min, "timequarter", parts=self._partitions
            ).withColumnRenamed("_used", "ingredient_quantity"),
            LOC,
            DAY,
        )

    def _ingredients(self, items: DataFrame, *keys: str, parts: int | None = None) -> DataFrame:
        lines = self.recipe.select(
            F.col("pin").alias("product"), "ingredient_id", "ingredient_quantity", "unit_of_measure"
        )
        used = F.col("sum_daily_quantity").cast("double") * F.col("ingredient_quantity")
        # The items are shuffled, not their several times as many recipe lines: the small
        # recipe keeps their partitions, in which every total is complete.  Their number is
        # given, as adaptive execution would size them before the recipe multiplies rows.
        parts = parts or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        spread = items.select(LOC, DAY, *keys, "product", "sum_daily_quantity").repartition(
            parts, LOC, DAY, *keys
        )
        return (
            spread.join(lines, "product")
            .groupBy(LOC, DAY, *keys, "ingredient_id", "unit_of_measure")
            .agg(F.round(F.sum(used), 4).alias("_used"))
        )

    def prepared(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(DAY) <= F.lit(LAST_PREPARED))

    def past(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(DAY) <= F.lit(days(-2)))

    # -- calendar ------------------------------------------------------------

    @cached_property
    def calendar_daily(self) -> DataFrame:
        return self.stored("calendar_daily", self._calendar, DAY)

    def _calendar(self) -> DataFrame:
        bounds = self.table("lineitem").agg(
            F.to_date(F.min("l_shipdate")).alias("a"),
            F.date_add(F.to_date(F.max("l_shipdate")), 60).alias("b"),
        )
        day = F.col(DAY)
        month, dom = F.month(day), F.dayofmonth(day)

        def on(m: int, d: int) -> Column:
            return (month == m) & (dom == d)

        def flag(c: Column) -> Column:
            return F.when(c, 1).otherwise(0)

        thanksgiving = (month == 11) & is_closed_holiday(day)
        name = (
            F.when(on(1, 1), "New-Years-Day")
            .when(on(7, 4), "Independence-Day")
            .when(on(11, 11), "Veterans-Day")
            .when(on(12, 25), "Christmas-Day")
            .when(thanksgiving, "Thanksgiving-Day")
            .otherwise("Regular-day")
        )
        return bounds.select(F.explode(F.sequence("a", "b")).alias(DAY)).select(
            DAY,
            dow_iso(day).alias("dayofweek"),
            flag(F.weekday(day) == 6).alias("sunday"),
            flag(is_closed_holiday(day)).alias("holiday"),
            flag(name != "Regular-day").alias("federalholiday"),
            flag((month == 11) & dom.between(20, 30)).alias("aroundthanksgiving"),
            flag((month == 12) & dom.between(22, 28)).alias("aroundchristmas"),
            flag(on(12, 24) | on(12, 31)).alias("onedaypriorchristmas_and_new_year"),
            flag((month == 11) & dom.between(23, 29) & (F.weekday(day) == 4)).alias(
                "blackfridaycheck"
            ),
            name.alias("federalholiday_name"),
        )

    @cached_property
    def calendar_15min(self) -> DataFrame:
        return (
            self.calendar_daily.select(DAY)
            .withColumn("_time", F.explode(quarter_hours()))
            .select(
                DAY,
                F.concat_ws(" ", F.col(DAY).cast("string"), "_time")
                .cast("timestamp_ntz")
                .alias("timequarter"),
            )
        )

    # -- store and recipe tables ---------------------------------------------

    @cached_property
    def stores(self) -> DataFrame:
        return self.table("nation").select((F.col("n_nationkey") + 1).cast("int").alias(LOC))

    @cached_property
    def saturday_off(self) -> DataFrame:
        return self.stores.where(F.col(LOC).isin(3, 7))

    @cached_property
    def settings(self) -> DataFrame:
        n = F.col("n_nationkey")
        percent = F.lpad(((n % 4) * 10).cast("string"), 2, "0")
        return (
            self.table("nation")
            .where(n % 5 != 4)
            .select(
                (n + 1).cast("int").alias(LOC),
                F.concat((n % 3 + 4).cast("string"), F.lit("-week"), percent).alias("naming_conv"),
            )
        )

    @cached_property
    def location_list(self) -> DataFrame:
        kind = F.when(F.col(LOC) % 2 == 1, "LSTM").otherwise("baseline")
        return self.stores.withColumn("forecast_type", kind)

    @cached_property
    def locations(self) -> DataFrame:
        kind = (F.col(LOC) - 1) % 6
        sentinel = F.lit(NO_DATE)

        def dates(offsets: dict[int, int]) -> Column:
            out = sentinel
            for k, n in offsets.items():
                out = F.when(kind == k, F.lit(days(n))).otherwise(out)
            return out

        projected = F.when(
            (kind.isin(2, 3, 4)) & (F.col(LOC) <= 16), F.lit(days(-90))
        ).otherwise(dates({1: 12, 5: -5}))
        return self.stores.select(
            LOC,
            dates({1: 10, 2: -30, 3: -60, 4: -100}).alias("remodelclosedate"),
            projected.alias("remodelprojectedclosedate"),
            dates({1: 40, 2: 30, 3: -10, 4: -50}).alias("remodelreopendate"),
            dates({5: 60}).alias("remodelprojectedreopendate"),
            F.lit(days(-1)).alias(GEN),
        )

    @cached_property
    def recipe_history(self) -> DataFrame:
        return self.stored("recipe_history", self._recipes)

    def _recipes(self) -> DataFrame:
        newest = (
            self.table("part")
            .groupBy(
                (F.col("p_partkey") % 20).cast("int").alias("pin"),
                (F.col("p_size") % 7).cast("int").alias("ingredient_id"),
            )
            .agg(
                # A thousandth of the mean price, cut to four digits.
                (
                    F.floor(
                        (F.sum(dec2(F.col("p_retailprice"))) * 100).cast("bigint")
                        / (F.count(F.lit(1)) * 10)
                    )
                    / F.lit(10000.0)
                ).alias("_quantity")
            )
        )
        unit = F.when(F.col("ingredient_id") % 2 == 0, "EA").otherwise("LB")
        versions = F.array(
            F.struct(F.lit(days(-1)).alias(GEN), F.lit(1.0).alias("share")),
            F.struct(F.lit(days(-31)).alias(GEN), F.lit(0.5).alias("share")),
        )
        return newest.withColumn("_v", F.explode(versions)).select(
            "pin",
            "ingredient_id",
            (F.col("_quantity") * F.col("_v.share")).alias("ingredient_quantity"),
            unit.alias("unit_of_measure"),
            F.col(f"_v.{GEN}").alias(GEN),
        )

    @cached_property
    def recipe(self) -> DataFrame:
        return self._whole.recipe_history.where(F.col(GEN) == F.lit(days(-1)))

    @cached_property
    def ycf(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            (F.col("s_nationkey") + 1).cast("int").alias(LOC),
            (key % 7).cast("int").alias("ingredient_id"),
            (F.lit(0.5) + (key % 10) / F.lit(10.0)).alias("ycf"),
            F.when(key % 4 == 0, F.lit(days(-31))).otherwise(F.lit(days(-1))).alias(GEN),
        )

    @cached_property
    def combinations(self) -> DataFrame:
        return self.items_daily.where(F.col("product") % 4 != 3).select(LOC, "product").distinct()

    @cached_property
    def expected_products(self) -> DataFrame:
        return self.stores.withColumn("products", (F.col(LOC) % 3 + 1).cast("bigint"))

    # -- forecasts and ratios ------------------------------------------------

    def _runs(self, df: DataFrame) -> DataFrame:
        """Two runs per store; every ninth store last ran a day earlier."""
        newest = F.date_sub(F.lit(AS_OF), F.when(F.col(LOC) % 9 == 0, 1).otherwise(0))
        return df.withColumn(GEN, F.explode(F.array(newest, F.date_sub(newest, 2))))

    def _near(self, facts: DataFrame, horizon: str) -> DataFrame:
        """Facts of the quarter-hours that the horizon's dates can have, for their newest versions.

        The cut is on a key of the versions, so a kept quarter-hour keeps all of them.  It has
        a day more on either side, as a quarter-hour need not lie within its business date.
        """
        first, last = (days(n - 364) for n in _reach(horizon))
        at = F.col("timequarter")
        near = (at >= F.lit(first - timedelta(days=1))) & (at < F.lit(last + timedelta(days=2)))
        return facts.where(near | at.isNull())

    def _ahead(self, latest: DataFrame, horizon: str) -> DataFrame:
        """Last year's facts as the forecast of the horizon's dates."""
        first, last = HORIZONS[horizon]
        # The dates of any store's runs, which lie up to three days back: cut in the scan.
        wanted = F.col(DAY).between(*(F.lit(days(n - 364)) for n in _reach(horizon)))
        shifted = latest.where(wanted).drop(GEN).withColumn(DAY, F.date_add(DAY, 364))
        ahead = F.datediff(F.col(DAY), F.col(GEN))
        return self._runs(shifted).where(ahead.between(first, last))

    def _forecast(self, name: str, latest: DataFrame, horizon: str, *columns) -> DataFrame:
        return self.stored(
            f"{name}_{horizon}",
            lambda: self._ahead(latest, horizon).select(LOC, DAY, *columns, GEN),
            LOC,
            DAY,
        )

    def forecast_sales(self, horizon: str = "short") -> DataFrame:
        value = F.col("sales_sub_total").cast("double").alias("forecast")
        return self._forecast("forecast_sales", self.latest_sales_daily, horizon, value)

    def forecast_trans(self, horizon: str = "short") -> DataFrame:
        value = F.col("trans_count").cast("double").alias("forecast")
        return self._forecast("forecast_trans", self.latest_sales_daily, horizon, value)

    def forecast_items(self, horizon: str = "short") -> DataFrame:
        return self._forecast(
            "forecast_items",
            self.latest_items_daily,
            horizon,
            F.col("product").alias("item_id"),
            F.col("sum_daily_quantity").cast("double").alias("forecast"),
        )

    def forecast_15min(self, horizon: str = "short") -> DataFrame:
        return self._forecast(
            "forecast_15min",
            self._latest_sales(self._near(self.near.sales_15min, horizon)),
            horizon,
            time_of_day(F.col("timequarter")).alias("interval_start_time"),
            F.col("sales_sub_total").cast("double").alias("forecast"),
            F.col("trans_count").cast("double").alias("forecast_tx"),
        )

    def forecast_items_15min(self, horizon: str = "short") -> DataFrame:
        return self._forecast(
            "forecast_items_15min",
            self._latest_items(self._near(self.near.items_15min, horizon)),
            horizon,
            F.col("product").alias("item_id"),
            time_of_day(F.col("timequarter")).alias("interval_start_time"),
            F.col("sum_daily_quantity").cast("double").alias("forecast"),
        )

    def forecast_ingredients_15min(self, horizon: str = "short") -> DataFrame:
        return self._forecast(
            "forecast_ingredients_15min",
            self._ingredients(
                self._latest_items(self._near(self.near.items_15min, horizon)), "timequarter"
            ),
            horizon,
            "ingredient_id",
            time_of_day(F.col("timequarter")).alias("interval_start_time"),
            F.col("_used").alias("forecast"),
        )

    def _ratios(self, part: DataFrame, whole: DataFrame, keys: list[str], measure: str):
        total = whole.select(*keys, F.col(measure).cast("double").alias("_total"))
        share = F.col(measure).cast("double") / F.col("_total")
        return (
            part.join(total, keys)
            .select(
                *[k for k in keys if k != DAY],
                F.date_add(DAY, 364).alias(DAY),
                time_of_day(F.col("timequarter")).alias("time"),
                share.alias("ratio"),
            )
            .where(F.col(DAY).between(F.lit(days(10)), F.lit(days(32))))
        )

    def metric_ratios(self, measure: str = "sales_sub_total") -> DataFrame:
        return self.stored(f"ratios_{measure}", lambda: self._metric_ratios(measure), LOC, DAY)

    def _metric_ratios(self, measure: str) -> DataFrame:
        ratios = self._ratios(
            self.latest_sales_15min, self.latest_sales_daily, [LOC, DAY], measure
        )
        older = F.col(GEN) < F.lit(days(-1))
        share = F.when(older, F.col("ratio") / 2).otherwise(F.col("ratio"))
        return self._runs(ratios).withColumn("ratio", share)

    def item_ratios(self) -> DataFrame:
        return self.stored("item_ratios", self._item_ratios, LOC, DAY)

    def _item_ratios(self) -> DataFrame:
        return self._ratios(
            self.latest_items_15min.where(F.col("product") % 5 != 0),
            self.latest_items_daily,
            [LOC, "product", DAY],
            "sum_daily_quantity",
        ).withColumn(GEN, F.lit(AS_OF))

    # -- check tables --------------------------------------------------------

    def control_sales(self, df: DataFrame) -> DataFrame:
        extra = F.when(F.col(LOC) % 6 == 5, F.lit(1)).otherwise(F.lit(0))
        return df.withColumn("sales_sub_total", dec2(F.col("sales_sub_total") + extra))

    def control_items(self, df: DataFrame) -> DataFrame:
        extra = F.when(F.col(LOC) % 6 == 4, F.lit(1)).otherwise(F.lit(0))
        return df.withColumn("sum_daily_quantity", dec2(F.col("sum_daily_quantity") + extra))

    def _checks(self, df: DataFrame, mark: Column) -> DataFrame:
        return (
            self.past(df)
            .groupBy(LOC, GEN)
            .agg(F.max(DAY).alias("business_date_max"))
            .withColumn("dailyqc", F.when(mark == 0, 0).otherwise(1))
        )

    @cached_property
    def metric_checks(self) -> DataFrame:
        return self._checks(self.sales_daily, (F.col(LOC) + F.dayofmonth(GEN)) % 5)

    @cached_property
    def item_checks(self) -> DataFrame:
        return self._checks(self.items_daily, (F.col(LOC) + F.dayofmonth(GEN) * 2) % 7)
