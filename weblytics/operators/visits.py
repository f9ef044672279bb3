"""Visit counts by place and by browser, in aggregate, DataFrame and SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.schema import PLACE_COLUMNS


def visits_by_place(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PLACE_COLUMNS).agg(F.count(F.lit(1)).alias("cnt"))


def visits_by_browser(rows: DataFrame) -> DataFrame:
    browser = F.col("browserName").alias("browsername")
    return rows.groupBy(browser).agg(F.count(F.lit(1)).alias("cnt"))


def ranked(counts: DataFrame, count: str = "cnt") -> DataFrame:
    """Largest count first; ties by the other columns, so the order is repeatable."""
    return counts.orderBy(F.desc(count), *[c for c in counts.columns if c != count])


def top_places(rows: DataFrame, n: int = 10) -> DataFrame:
    return ranked(visits_by_place(rows)).limit(n)


def visits_by_place_df(rows: DataFrame) -> DataFrame:
    places = rows.select(*PLACE_COLUMNS)
    return places.groupBy(*PLACE_COLUMNS).count().orderBy(F.desc("count"), *PLACE_COLUMNS)


def visits_by_browser_df(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("browserName").alias("browsername")).groupBy("browsername").count()


def visits_by_place_sql(rows: DataFrame, view: str = "location") -> DataFrame:
    """Registers the places as a temp view and counts them in SQL."""
    rows.select(*PLACE_COLUMNS).createOrReplaceTempView(view)
    return rows.sparkSession.sql(
        f"""
        SELECT country, province, count(1) AS cnt
        FROM {view}
        GROUP BY country, province
        ORDER BY cnt DESC, country, province
        """
    )


def browser_stat(rows: DataFrame) -> DataFrame:
    """The result table ``(day, browsername, cnt INT)``: visits by browser for each day."""
    browser = F.col("browserName").alias("browsername")
    counts = rows.groupBy("day", browser).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.withColumn("cnt", F.col("cnt").cast("int"))


def visit_rankings(rows: DataFrame) -> DataFrame:
    """Both counts, by place and by browser, from one pass: ``(ranking, country, province, browsername, cnt)``.

    One aggregate over two grouping sets: each row goes to both before the shuffle, and the partial sums shrink them
    there. ``grouping`` tells a column left out of a set from a null value. Ordered like ``ranked``, within each ranking.
    """
    named = rows.select(*PLACE_COLUMNS, F.col("browserName").alias("browsername"))
    sets = [[F.col(c) for c in PLACE_COLUMNS], [F.col("browsername")]]
    counts = named.groupingSets(sets, *named.columns).agg(
        F.count(F.lit(1)).alias("cnt"), F.grouping("browsername").alias("_places")
    )
    ranking = F.when(F.col("_places") == 1, "place").otherwise("browser").alias("ranking")
    return counts.select(ranking, *named.columns, "cnt").orderBy("ranking", F.desc("cnt"), *named.columns)
