import datetime as dt
import math

import pytest

from barloom.operators import lookup, selection
from barloom.schema import EMERGENCY_SEED_IDS, DiscoverConfig, IngestConfig, SelectionConfig
from helpers import at, plan, rows

STATS = ("item_id long, name string, median_units_per_day double, median_price double, median_turnover_gp double, "
         "coverage_pct double, days_with_data long, avg_price double, ranking_score double, last_trade_date date")


def stats(spark, *items):
    """items: (id, units, coverage, days)."""
    data = [(i, f"Item {i}", float(u), 10.0, 10.0 * u, float(c), n, 10.0, math.log10(u + 1) * c / 100, dt.date(2024, 1, 30))
            for i, u, c, n in items]
    return spark.createDataFrame(data, STATS)


@pytest.fixture(scope="module")
def mapping(spark):
    return spark.createDataFrame([(1, "Item 1"), (2, "Item 2"), (3, "Item 3"), (8, "Twin"), (9, "TWIN")], "id long, name string")


@pytest.fixture(scope="module")
def table(spark):
    return stats(spark, (1, 5000, 90, 27), (2, 4000, 90, 27), (3, 50, 90, 27), (4, 9000, 1, 27), (5, 9000, 90, 2))


def picked(df):
    return [(r.id, r.selection_reason) for r in selection.ranked(df).collect()]


BASE = dict(min_days=10, min_volume=1000, min_coverage_pct=2.0)


def test_auto_applies_every_gate(table, mapping):
    assert picked(selection.select_items(table, mapping, SelectionConfig(**BASE))) == [(1, "auto_selected"), (2, "auto_selected")]


def test_auto_cuts_at_top_n_and_respects_excludes(table, mapping):
    config = SelectionConfig(**BASE, top_n=1, exclude_names=("  item 1 ",))
    assert picked(selection.select_items(table, mapping, config)) == [(2, "auto_selected")]


def test_manual_label_wins_even_when_ranked(table, mapping):
    config = SelectionConfig(**BASE, include_names=("ITEM 2",))
    assert picked(selection.select_items(table, mapping, config)) == [(1, "auto_selected"), (2, "manual_include")]


def test_hybrid_volume_gate_and_force(table, mapping):
    config = SelectionConfig(**BASE, top_n=1, include_ids=(2, 3, 4))
    assert picked(selection.select_items(table, mapping, config, "hybrid")) == [(1, "auto_selected"), (2, "manual_include")]
    forced = picked(selection.select_items(table, mapping, config, "hybrid", True))
    assert forced == [(1, "auto_selected"), (2, "manual_include"), (3, "manual_include")]


def test_manual_mode(table, mapping):
    config = SelectionConfig(**BASE, include_ids=(3, 5), include_names=("twin",))
    assert picked(selection.select_items(table, mapping, config, "manual")) == [(3, "manual_include")]
    assert picked(selection.select_items(table, mapping, SelectionConfig(**BASE), "manual")) == []


def test_unknown_mode(table, mapping):
    with pytest.raises(ValueError):
        selection.select_items(table, mapping, SelectionConfig(), "best")


def test_names_skip_or_first(spark, mapping):
    wanted = lookup.name_frame(spark, [" item 1 ", "twin", "ghost", "Item 3"])
    assert sorted(rows(lookup.resolve_names(wanted, mapping, "skip"), "item_id")) == [(1,), (3,)]
    assert sorted(rows(lookup.resolve_names(wanted, mapping, "first"), "item_id")) == [(3,), (8,)]
    missed = {(r.name, r.reason) for r in lookup.unresolved_names(wanted, mapping, "skip").collect()}
    assert missed == {("twin", "ambiguous"), ("ghost", "unknown")}


def test_listed_names_give_the_same(spark, mapping):
    names = [" item 1 ", "twin", "ghost", "Item 3"]
    for mode in ("skip", "first"):
        a = sorted(rows(lookup.resolve_name_list(names, mapping, mode)))
        assert a == sorted(rows(lookup.resolve_names(lookup.name_frame(spark, names), mapping, mode).select("pos", "name", "item_id")))


def test_discovery(spark):
    items = spark.createDataFrame([(1, 500, True), (2, 9000, False), (3, 9000, True), (4, 1000, None), (5, None, True)], "id long, limit long, members boolean")
    assert rows(lookup.auto_discover(items, 1000, None, 2), "item_id") == [(2,), (3,)]
    assert rows(lookup.auto_discover(items, 1000, True, 5), "item_id") == [(3,)]


def targets(df):
    return [r.item_id for r in df.orderBy("rank_source", "rank_pos", "item_id").collect()]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(i, f"Item {i}", 1000 * i, True) for i in range(1, 8)] + [(8, "Twin", 100, True), (9, "TWIN", 100, True)],
        "id long, name string, limit long, members boolean")


def test_targets_by_priority(spark, items):
    config = IngestConfig(include_ids=(6, 2), include_names=("TWIN", "item 3"), exclude_ids=(7,), exclude_names=("Item 6",),
                          discover=DiscoverConfig(enabled=True, top_k=4, min_limit=1000), max_items=5)
    chosen = lookup.id_frame(spark, [4, 2]).select("item_id", "pos")
    # selection 4, 2; listed 2; names 8 (first of the twins), 3; discovered 7, 6, 5, 4
    assert targets(selection.ingest_targets(items, config, chosen)) == [4, 2, 8, 3, 5]


def test_targets_cap_and_seed(spark, items):
    assert targets(selection.ingest_targets(items, IngestConfig(include_ids=(1, 2, 3), max_items=2))) == [1, 2]
    assert targets(selection.ingest_targets(items, IngestConfig(include_ids=(1,), exclude_ids=(1,)))) == list(EMERGENCY_SEED_IDS)
    assert targets(selection.ingest_targets(items, IngestConfig(max_items=1))) == list(EMERGENCY_SEED_IDS)


def test_short_lists_are_broadcast(spark, table, mapping):
    text = plan(lookup.only_ids(table, lookup.id_frame(spark, [1, 2])))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_statistics(spark):
    silver = spark.createDataFrame(
        [(1, at(d), p, p, v, at(d)) for d, p, v in ((1, 10, 100), (2, 20, 200), (3, 30, 0), (4, 40, 400), (5, 50, 500), (6, 60, 600))]
        + [(1, at(2, 1), None, 9, 50, at(2))],
        "item_id long, ts timestamp_ntz, price_avg_high long, price_avg_low long, volume long, load_ts timestamp_ntz")
    items = spark.createDataFrame([(1, "One")], "id long, name string")
    r = selection.item_statistics(silver, items, 10, "2024-01-10 00:00:00").first()
    assert (r.days_with_data, r.median_units_per_day, r.total_units, r.coverage_pct) == (5, 400.0, 1850.0, 50.0)
    assert (r.median_price, r.avg_price, r.last_trade_date) == (40.0, 36.0, dt.date(2024, 1, 6))
    assert abs(r.ranking_score - math.log10(401) * 0.5) < 1e-12
    # the boundary: one second later the first day drops out, and with it the minimum of five days
    assert selection.item_statistics(silver, items, 9, "2024-01-10 00:00:01").count() == 0
