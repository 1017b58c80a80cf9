"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars by nation: prices of the line items of its suppliers, in a fixed order within the day."""
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    place = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    items = items.select(F.col("n_name").alias("symbol"), F.to_date("l_shipdate").alias("date"), price.cast("double").alias("price"), F.col("l_quantity").cast("double").alias("quantity"), place.alias("k"))
    return items.groupBy("symbol", "date").agg(F.min_by("price", "k").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "k").alias("close"), F.sum("quantity").alias("volume"))


BARS_SQL = """bars AS (SELECT n_name AS symbol, l_shipdate::DATE AS date,
  min_by(p, k) AS open, max(p) AS high, min(p) AS low, max_by(p, k) AS close, sum(q) AS volume
  FROM (SELECT n_name, l_shipdate, (l_extendedprice / l_quantity)::DOUBLE AS p, l_quantity::DOUBLE AS q, {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_suppkey} AS k
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey) GROUP BY ALL)"""


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars with gaps, zero prices, crossed ranges and negative volumes, placed by the volume."""
    v = F.col("volume").cast("int")
    return bars(spark, sf_dir).select(
        "symbol",
        "date",
        F.when(v % 7 != 0, F.col("open")).alias("open"),
        F.when(v % 13 == 0, F.col("low") * 0.9).otherwise(F.col("high")).alias("high"),
        "low",
        F.when(v % 11 == 0, 0.0).otherwise(F.col("close")).alias("close"),
        F.when(v % 17 == 0, -F.col("volume")).when(v % 19 != 0, F.col("volume")).alias("volume"),
    )


DIRTY_SQL = f"""{BARS_SQL}, dirty AS (SELECT symbol, date, CASE WHEN volume::INT % 7 != 0 THEN open END AS open,
  CASE WHEN volume::INT % 13 = 0 THEN low * 0.9::DOUBLE ELSE high END AS high, low, CASE WHEN volume::INT % 11 = 0 THEN 0.0 ELSE close END::DOUBLE AS close,
  CASE WHEN volume::INT % 17 = 0 THEN -volume WHEN volume::INT % 19 != 0 THEN volume END AS volume FROM bars)"""

#: Nations that act as funds, and the funds that the others map to by region.
FUNDS = ["NATION_0", "NATION_1", "NATION_2"]


def fund_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol and etf: each nation outside FUNDS maps to one fund, those of odd regions to two."""
    nation = table(spark, sf_dir, "nation").where(~F.col("n_name").isin(FUNDS))
    one = nation.select(F.col("n_name").alias("symbol"), F.concat(F.lit("NATION_"), (F.col("n_regionkey") % 3).cast("string")).alias("etf"))
    two = nation.where("n_regionkey % 2 = 1").select(F.col("n_name").alias("symbol"), F.concat(F.lit("NATION_"), ((F.col("n_regionkey") + 1) % 3).cast("string")).alias("etf"))
    return one.union(two)


FUND_SQL = """fund_map AS (SELECT n_name AS symbol, 'NATION_' || (n_regionkey % 3) AS etf FROM nation WHERE n_name NOT IN ('NATION_0', 'NATION_1', 'NATION_2')
  UNION ALL SELECT n_name, 'NATION_' || ((n_regionkey + 1) % 3) FROM nation WHERE n_name NOT IN ('NATION_0', 'NATION_1', 'NATION_2') AND n_regionkey % 2 = 1)"""


def sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values: list, number: Column) -> Column:
    """The value at a number's place, counted round."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(number, F.lit(len(values))).cast("int"))


def days_of(df: DataFrame, column: str = "date") -> tuple[str, str]:
    """First and last day of a table, by one aggregate."""
    first, last = df.agg(F.min(F.to_date(column)), F.max(F.to_date(column))).first()
    return str(first), str(last)


def order_days(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return days_of(table(spark, sf_dir, "orders"), "o_orderdate")


ORDER_DAYS_SQL = ("(SELECT min(o_orderdate)::DATE FROM orders)", "(SELECT max(o_orderdate)::DATE FROM orders)")

POSITIONS = ["Director", "EVP", "General Counsel", "Secretary", "Treasurer", "Controller", "Chairman", "Managing Director", "10% Owner", "Chief Executive Officer", "Principal Accounting", "Vice Chair", "President and CEO", "VP of Engineering", "cfo", "SVP, COO", "CTO", None, "Preceo", "vps"]


def insider_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions from events: code by type, position by the property."""
    code = F.create_map(*[F.lit(x) for p in (("click", "P"), ("view", "S"), ("signup", "A"), ("error", "F"), ("purchase", "M")) for x in p])
    e = table(spark, sf_dir, "events")
    prop = F.get_json_object(F.col("props").cast("string"), "$.k").cast("int")
    return e.select(
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("ticker"),
        F.to_date("ts").alias("date"),
        F.element_at(code, F.col("event_type")).alias("code"),
        F.col("value").cast("double").alias("shares"),
        (F.col("value") * 10).cast("double").alias("value"),
        pick(POSITIONS, prop).alias("position"),
    )


INSIDER_SQL = f"""insider AS (SELECT 'NATION_' || (user_id % 25) AS ticker, ts::DATE AS date,
  CASE event_type WHEN 'click' THEN 'P' WHEN 'view' THEN 'S' WHEN 'signup' THEN 'A' WHEN 'error' THEN 'F' WHEN 'purchase' THEN 'M' END AS code,
  value::DOUBLE AS shares, value::DOUBLE * 10 AS value, ({sql_list(POSITIONS)})[json_extract_string(props, '$.k')::INT % {len(POSITIONS)} + 1] AS position FROM events)"""

#: Grades as firms spell them: every known one, some that only hold one, and some of no leaning.
GRADE_NAMES = ["Buy", "Overweight", "Outperform", "Strong Buy", "Positive", "Sector Outperform", "Top Pick", "Conviction Buy", "Accumulate", "Above Average", "Add", "Long-Term Buy", "Market Outperform", "Strong Outperform", "Sector Perform/Outperform", "Sell", "Underweight", "Underperform", "Reduce", "Negative", "Sector Underperform", "Strong Sell", "Avoid", "Below Average", "Market Underperform", "Hold", "Neutral", "Equal-Weight", "Market Perform", "Sector Perform", "Peer Perform", "In-Line", "Perform", "Sector Weight", "Market Weight", "Fair Value", " hold ", "Speculative Buy", "Tactical Sell", "Long-term hold", "Mixed", "", None]
ACTIONS = ["up", "down", "init", "Initiated", "reit", "main", "Upgrade", "initiation", None]


def analyst_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price targets and grades from orders: firm by priority, target by price, grade and action by the key."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("o_orderkey")
    rows = o.select(F.col("n_name").alias("ticker"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("firm"), F.col("o_totalprice").cast("double").alias("target"), pick(GRADE_NAMES, key).alias("to_grade"), pick(ACTIONS, F.floor(key / 7)).alias("action"), key.alias("id"))
    return rows.withColumn("from_grade", F.lag("to_grade").over(Window.partitionBy("ticker", "firm").orderBy("date", "id")))


ANALYST_SQL = f"""analyst AS (SELECT *, lag(to_grade) OVER (PARTITION BY ticker, firm ORDER BY date, id) AS from_grade FROM (
  SELECT n_name AS ticker, o_orderdate::DATE AS date, o_orderpriority AS firm, o_totalprice::DOUBLE AS target,
  ({sql_list(GRADE_NAMES)})[o_orderkey % {len(GRADE_NAMES)} + 1] AS to_grade, ({sql_list(ACTIONS)})[o_orderkey // 7 % {len(ACTIONS)} + 1] AS action, o_orderkey AS id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))"""


def macro_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, series, value: daily mean order price of each priority (series r1 to r5), scaled by a thousand."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("date"), F.concat(F.lit("r"), F.substring("o_orderpriority", 1, 1)).alias("series")).agg((F.avg(F.col("o_totalprice").cast("double")) / 1000).alias("value"))


MACRO_SQL = """series AS (SELECT o_orderdate::DATE AS date, 'r' || o_orderpriority[1] AS series, avg(o_totalprice::DOUBLE) / 1000 AS value FROM orders GROUP BY ALL)"""


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PANEL = [f"r{p}_{s.lower()}" for p in range(1, 6) for s in SEGMENTS]


def macro_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, series, value: daily mean order price of each priority and market segment (25 series), scaled by a thousand."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    name = F.concat(F.lit("r"), F.substring("o_orderpriority", 1, 1), F.lit("_"), F.lower("c_mktsegment"))
    return o.groupBy(F.to_date("o_orderdate").alias("date"), name.alias("series")).agg((F.avg(F.col("o_totalprice").cast("double")) / 1000).alias("value"))


PANEL_SQL = """panel AS (SELECT o_orderdate::DATE AS date, 'r' || o_orderpriority[1] || '_' || lower(c_mktsegment) AS series, avg(o_totalprice::DOUBLE) / 1000 AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles from documents: ticker and day by the id; the first line is the headline, the rest the description."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("NATION_"), (F.col("doc_id") % 25).cast("string")).alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("date"),
        F.substring_index("text", "\n", 1).alias("headline"),
        F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("description"),
        "source",
    )


ARTICLES_SQL = """articles AS (SELECT doc_id AS id, 'NATION_' || (doc_id % 25) AS ticker, DATE '2024-01-01' + (doc_id % 30)::INT AS date, split_part(text, chr(10), 1) AS headline, substr(text, length(split_part(text, chr(10), 1)) + 2) AS description, source FROM documents)"""
