import json

from pyspark.sql import functions as F

from weblytics.operators.parse import GOOD, REJECTED, parse_lines, routed_lines, unparsed_lines
from weblytics.operators.visits import ranked, visit_rankings, visits_by_browser, visits_by_place
from weblytics.plans.fixtures import log_lines
from weblytics.sinks.routes import FIELDS, read_route, start_routes, write_routes
from weblytics.sources.logs import stream_lines

ODD = ["", "garbage", None, '1.2.3.4 - - [9/Nov/2015:03:50:05 +0000] "GET / HTTP/1.1" 200 5 "a" "b" extra',
       ' - - [29/Nov/2015:03:50:05 +0800] "" 400 - "-" ""', "two\nlines", "a\rb"]


def lines_of(spark, sf_dir):
    return log_lines(spark, sf_dir).select("line").unionByName(spark.createDataFrame([(x,) for x in ODD], "line string"))


def bag(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def test_one_job_splits_all_lines(spark, sf_dir, tmp_path):
    lines, path = lines_of(spark, sf_dir), str(tmp_path / "routes")
    counts = write_routes(lines, path)
    good, rejected = read_route(spark, path, GOOD), read_route(spark, path, REJECTED)
    assert counts == {GOOD: good.count(), REJECTED: rejected.count()}
    assert sum(counts.values()) == lines.count()
    assert bag(good) == bag(parse_lines(lines).select(*FIELDS))
    assert bag(rejected) == bag(unparsed_lines(lines))


def test_one_regex_pass(spark, sf_dir, plan):
    assert plan(routed_lines(log_lines(spark, sf_dir))).count("regexp_replace") == 1


def test_stream_counts_what_it_routes(spark, sf_dir, tmp_path):
    source, path = str(tmp_path / "log"), str(tmp_path / "routes")
    log_lines(spark, sf_dir).select("line").write.text(source)
    query = start_routes(stream_lines(spark, source), path, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    seen = [json.loads(p.json)["observedMetrics"]["lines"] for p in query.recentProgress if p.numInputRows]
    for route in (GOOD, REJECTED):
        assert read_route(spark, path, route).count() == sum(s[route] for s in seen) > 0
    assert bag(read_route(spark, path, GOOD)) == bag(parse_lines(spark.read.text(source).withColumnRenamed("value", "line")).select(*FIELDS))


def test_both_rankings_in_one_pass(spark, plan):
    rows = spark.createDataFrame(
        [("A", "x", "F"), ("A", "x", None), ("A", None, "F"), (None, None, "C"), ("B", "y", "C"), ("B", "y", "C")],
        "country string, province string, browserName string",
    )
    both = visit_rankings(rows)
    places = both.where("ranking = 'place'").select("country", "province", "cnt")
    browsers = both.where("ranking = 'browser'").select("browsername", "cnt")
    assert [tuple(r) for r in places.collect()] == [tuple(r) for r in ranked(visits_by_place(rows)).collect()]
    assert [tuple(r) for r in browsers.collect()] == [tuple(r) for r in ranked(visits_by_browser(rows)).collect()]
    text = plan(both)
    assert text.count("Scan") == 1 and text.count("hashpartitioning") == 1
    assert visit_rankings(rows.where(F.lit(False))).count() == 0
