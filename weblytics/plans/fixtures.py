"""Access-log lines and IP ranges derived from the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.functions.clock import ntz_day
from weblytics.operators.agent_rules import shipped_rules
from weblytics.sources.orders import read_events

# --- Fixed values: user agents of the rendered lines, by user_id % 5 ---
AGENTS = (
    "Mozilla/4.0 (compatible; MSIE 7.0; Windows NT 5.1; )",
    "Mozilla/5.0 (X11; Linux x86_64; rv:120.0) Gecko/20100101 Firefox/120.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15) AppleWebKit/537.36 "
    "(KHTML, like Gecko) Chrome/119.0 Safari/537.36",
    "curl/8.0",
    "",
)
# --- End of fixed values ---

SHIPPED_PRIORITY = 1_000_000_000  # behind the rules of all units
SLASH_16 = 1 << 16
TEN_SLASH_8 = 10 << 24


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, f"{sf_dir}/events.parquet")


def render_lines(source: DataFrame) -> DataFrame:
    """``(day, line)``, one log line for each event, some of them dirty."""
    event, user, ts = F.col("event_id"), F.col("user_id"), F.col("ts")

    def text(number: Column) -> Column:
        return number.cast("string")

    ip = F.when(event % 13 == 0, "").otherwise(
        F.concat(F.lit("10."), text(user % 32), F.lit("."), text(event % 4), F.lit(".1"))
    )
    date = F.date_format(ts.cast("date"), "dd/MMM/yyyy")
    clock = F.substring(ts.cast("string"), 12, 8)
    method = F.when(F.col("event_type") == "purchase", "POST").otherwise("GET")
    request = F.when(event % 11 == 0, "BAD").otherwise(
        F.concat(method, F.lit(" /p/"), text(event % 7), F.lit(" HTTP/1.1"))
    )
    status = F.when(F.col("event_type") == "error", "500").otherwise("200")
    sent = F.when(event % 5 == 0, "-").otherwise(text(F.floor("value").cast("bigint")))
    refer = F.when(user % 2 == 0, "-").otherwise(
        F.concat(F.lit("http://ref"), text(user % 3), F.lit(".example.org/"))
    )
    agent = F.element_at(F.array(*[F.lit(a) for a in AGENTS]), (user % 5 + 1).cast("int"))
    line = F.format_string(
        '%s - - [%s:%s +0000] "%s" %s %s "%s" "%s"',
        ip, date, clock, request, status, sent, refer, agent,
    )
    corrupt = F.concat(F.lit("corrupt "), text(event))
    return source.select(
        ntz_day(ts).alias("day"), F.when(event % 17 == 0, corrupt).otherwise(line).alias("line")
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered log, dealt out first: rendering and parsing cost far more than reading the events."""
    source = events(spark, sf_dir)
    return render_lines(source.repartition(spark.sparkContext.defaultParallelism))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``10.k.0.0`` to ``10.k.255.255`` is nation k of its region."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    start = F.col("n_nationkey").cast("bigint") * SLASH_16 + TEN_SLASH_8
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        start.alias("start_ip"),
        (start + (SLASH_16 - 1)).alias("end_ip"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("province"),
    )


def mixed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of many widths by nation number k: a /16 block below 10; 300 pieces of 128 addresses, 192 apart,
    from 10 to 14; four blocks at 15; none to 19; 256 addresses from 20 on."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    k = F.col("n_nationkey")
    start = k.cast("bigint") * SLASH_16 + TEN_SLASH_8 + F.col("i") * 192
    width = F.when(k < 10, SLASH_16).when(k < 15, 128).when(k == 15, 4 * SLASH_16).otherwise(256)
    parts = F.sequence(F.lit(0), F.when(k.between(10, 14), 299).otherwise(0))
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).where(~k.between(16, 19))
    return rows.withColumn("i", F.explode(parts)).select(
        start.alias("start_ip"),
        (start + width - 1).alias("end_ip"),
        F.col("r_name").alias("country"),
        F.concat("n_name", F.lit(" "), F.col("i").cast("string")).alias("province"),
    )


def nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each nation k: its /16 block, a /24 block inside, a range that overlaps the end of that one, and one address
    inside; and for each region all blocks from its first to its last nation, which overlap each other."""
    whole = ip_ranges(spark, sf_dir)
    start = F.col("start_ip")
    parts = ((256, 511, " inner"), (384, 767, " across"), (769, 769, " host"))
    inside = [
        whole.select((start + a).alias("start_ip"), (start + b).alias("end_ip"), "country", F.concat("province", F.lit(name)).alias("province"))
        for a, b, name in parts
    ]
    regions = whole.groupBy("country").agg(
        F.min("start_ip").alias("start_ip"), F.max("end_ip").alias("end_ip"), F.lit("all").alias("province")
    )
    return reduce(DataFrame.unionByName, [whole, *inside, regions])


def numbered_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An agent for each event: one of ``AGENTS`` and the number of a unit."""
    user, event = F.col("user_id"), F.col("event_id")
    base = F.element_at(F.array(*[F.lit(a) for a in AGENTS]), (user % 5 + 1).cast("int"))
    unit = F.concat(F.lit(" Unit/"), (event % 5000).cast("string"), F.lit("."), (user % 7).cast("string"))
    return events(spark, sf_dir).select(F.when(event % 19 != 0, F.concat(base, unit)).otherwise(base).alias("agent"))


def unit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A browser and a system rule for each part, before the shipped ones; some fit several agents or none."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"))
    key, number = F.col("k").cast("string"), F.col("k").cast("int")
    browsers = part.select(
        F.lit("browser").alias("kind"), number.alias("priority"), F.concat(F.lit("Unit/"), key, F.lit(".")).alias("token"),
        F.concat(F.lit("Unit "), key).alias("name"), F.concat(F.lit("/"), key, F.lit(".")).alias("detail"),
    )
    systems = part.where("k % 3 = 0").select(
        F.lit("system").alias("kind"), (-number).alias("priority"), F.concat(key, F.lit(".")).alias("token"),
        F.lit("Unit").alias("name"), F.concat(F.lit("Unit system "), key).alias("detail"),
    )
    return browsers.unionByName(systems).unionByName(shipped_rules(spark, SHIPPED_PRIORITY))
