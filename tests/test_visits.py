"""Visit counts in their three forms."""

import pytest

from weblytics.operators import visits as V

PLACES = [("A", "x")] * 3 + [("A", "y")] * 3 + [("B", "x")] * 5 + [(None, None)] * 2
BROWSERS = ["IE", "IE", None, "Firefox"]


@pytest.fixture
def places(spark):
    return spark.createDataFrame(PLACES, "country string, province string")


@pytest.fixture
def browsers(spark):
    return spark.createDataFrame([(b,) for b in BROWSERS], "browserName string")


EXPECTED = [("B", "x", 5), ("A", "x", 3), ("A", "y", 3), (None, None, 2)]


def test_three_forms_agree(places):
    forms = (
        V.ranked(V.visits_by_place(places)),
        V.visits_by_place_df(places),
        V.visits_by_place_sql(places),
    )
    for form in forms:
        assert [tuple(r) for r in form.collect()] == EXPECTED
    assert [f.columns[-1] for f in forms] == ["cnt", "count", "cnt"]


def test_sql_form_registers_its_view(spark, places):
    V.visits_by_place_sql(places, view="some_places")
    assert spark.table("some_places").count() == len(PLACES)


def test_top_places_is_a_top_k_after_one_exchange(places, plan):
    top = V.top_places(places, 2)
    text = plan(top)
    assert "TakeOrderedAndProject" in text
    assert text.count("Exchange ") == 1
    assert [tuple(r) for r in top.collect()] == EXPECTED[:2]


def test_browsers(browsers):
    ranked = V.ranked(V.visits_by_browser(browsers))
    assert [tuple(r) for r in ranked.collect()] == [("IE", 2), (None, 1), ("Firefox", 1)]
    counts = V.visits_by_browser_df(browsers)
    assert counts.columns == ["browsername", "count"]
    assert {tuple(r) for r in counts.collect()} == {("IE", 2), (None, 1), ("Firefox", 1)}


def test_counts_combine_before_the_shuffle(browsers, plan):
    assert "partial_count" in plan(V.visits_by_browser(browsers))
