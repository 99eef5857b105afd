import datetime as dt

import pytest

from barloom.catalog.queries import QUERIES, SQL
from barloom.operators import lookup, serving
from helpers import plan, rows

D = dt.date


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([(i, n, p) for i, n, p in ((1, "Beta", 10), (2, "Alpha", None), (3, "Gamma", 30))], "item_id long, name string, latest_price long")


def test_pages(spark, catalog):
    assert rows(serving.items_page(catalog, 1, 2)) == [(2, "Alpha", 3, 1, 2, 2), (1, "Beta", 3, 1, 2, 2)]
    assert rows(serving.items_page(catalog, 2, 2), "item_id") == [(3,)]
    with pytest.raises(ValueError, match="there are 2 pages"):
        serving.items_page(catalog, 3, 2)
    curated = lookup.id_frame(spark, [3, 77])
    assert rows(serving.items_page(catalog, curated=curated), "item_id", "total_count") == [(3, 1)]
    assert serving.items_page(catalog.where("false")).count() == 0


def test_pages_by_key_equal_pages_by_offset(spark, monkeypatch):
    names = [None, None, "b", "a", "a", "a", "", "z z", "A"] + [f"n{i % 13}" for i in range(60)]
    listed = spark.createDataFrame(list(enumerate(names)), "item_id long, name string").repartition(6)
    order = [r.item_id for r in listed.orderBy("name", "item_id").collect()]
    index = serving.settled(serving.page_index(listed, 10), "index")
    monkeypatch.setattr(serving, "page_index", None)  # a stored index is all a page needs
    for page in range(1, 8):
        got = serving.items_page(listed, page, 10, index=index)
        assert [r.item_id for r in got.collect()] == order[10 * page - 10 : 10 * page]
        assert "Offset" not in plan(got) and "LocalLimit" not in plan(got)
    with pytest.raises(ValueError, match="there are 7 pages"):
        serving.items_page(listed, 8, 10, index=index)


def test_a_page_past_the_end_is_empty_if_asked(spark, catalog):
    assert rows(serving.items_page(catalog, 3, 2, strict=False)) == []
    assert serving.items_page(catalog.where("false"), 2, strict=False).count() == 0


def test_the_registered_page_holds_forty_items(spark):
    page = QUERIES["items_page"](spark, "/root/testdata/sf0.01")
    assert "LIMIT 40 OFFSET 40" in SQL["items_page"] and page.count() == 40


def test_predictions(spark, catalog):
    feats = spark.createDataFrame(
        [(1, D(2024, 1, d), float(d)) for d in range(1, 21)] + [(2, D(2024, 1, d), 1.0) for d in range(1, 7)]
        + [(3, D(2024, 1, d), None if d == 10 else 4.0 * d) for d in range(1, 11)],
        "item_id long, date date, latest_price double")
    out = {r.item_id: r for r in serving.predict_batch(feats, catalog, 2).collect()}
    assert out[1].forecast == [17.0, 17.0] and out[1].current_price == 10.0 and out[1].status == "ok"
    assert out[1].lower == [None, None] and out[1].upper == [None, None]
    assert out[2].forecast is None and out[2].status == "insufficient_data" and out[2].current_price == 0.0
    assert out[3].forecast == [26.0, 26.0]  # mean of days 4 to 9
    with pytest.raises(ValueError):
        serving.predict_batch(feats, catalog, 8)


SCORES = "item_id long, date date, method string, mae double, smape double"


def test_recent_metrics_take_the_most_evaluated_method(spark, catalog):
    scores = spark.createDataFrame(
        [(1, D(2024, 1, d), "ets", 1.0, 1.0) for d in (20, 21)] + [(1, D(2024, 1, 20), "last_value", 9.0, 9.0), (1, D(2023, 1, 1), "last_value", 9.0, 9.0),
         (2, D(2024, 1, 1), "ets", 5.0, 5.0)], SCORES)
    got = rows(serving.item_metrics_recent(scores, catalog, "15d", "2024-01-31"), "item_id", "model_name", "n_predictions", "mae")
    assert got == [(1, "ets", 2, 1.0)]
    with pytest.raises(ValueError):
        serving.item_metrics_recent(scores, catalog, "15")


def test_leaderboard_order_and_ties(spark):
    items = spark.createDataFrame([(1, "A"), (2, "B")], "id long, name string")
    scores = spark.createDataFrame(
        [(1, D(2024, 1, 20), "ets", 3.0, 5.0), (1, D(2024, 1, 20), "last_value", 2.0, 5.0), (2, D(2024, 1, 20), "ets", None, None),
         (2, D(2024, 1, 20), "moving_average", 1500.0, 9.0), (9, D(2024, 1, 20), "ets", 0.0, 0.0)], SCORES)
    board = serving.leaderboard(scores, items, "30d", "2024-01-31 00:00:00")
    assert sorted(rows(board, "item_id", "method", "mae")) == [(1, "last_value", 2.0), (2, "moving_average", 1500.0)]
    assert rows(serving.leaderboard_top(board, 5), "method", "smape_text", "mae_text") == [("last value", "5.00%", "2"), ("moving average", "9.00%", "1.5K")]


def test_leaderboard_cutoff_is_an_instant(spark):
    items = spark.createDataFrame([(1, "A")], "id long, name string")
    scores = spark.createDataFrame([(1, D(2024, 1, 1), "ets", 1.0, 1.0)], SCORES)
    assert serving.leaderboard(scores, items, "30d", "2024-01-31 00:00:00").count() == 1
    assert serving.leaderboard(scores, items, "30d", "2024-01-31 00:00:01").count() == 0
    assert serving.leaderboard(scores, items, "whenever", "2024-01-31 00:00:00").count() == 1
