import json
import os
import subprocess
import sys
import textwrap

from barloom import config
from barloom.schema import DiscoverConfig, IngestConfig, SelectionConfig
from barloom.session import scratch_path
from barloom.sources import landing
from helpers import rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_defaults():
    assert config.selection_config({}) == SelectionConfig()
    assert config.ingest_config({}) == IngestConfig()


def test_sections(tmp_path):
    path = tmp_path / "items.json"
    path.write_text(json.dumps({
        "auto_select": {"top_n": 3, "min_coverage_pct": 2.0}, "manual_include": [1], "manual_include_names": ["A"], "manual_exclude": None,
        "ingest_targets": {"include_ids": [7], "auto_discover": {"enabled": True, "top_k": 4}},
        "runtime_caps": {"max_items_per_run": 9, "request_sleep_ms": 1}}))
    loaded = config.load_config(str(path))
    assert config.selection_config(loaded) == SelectionConfig(top_n=3, min_coverage_pct=2.0, include_ids=(1,), include_names=("A",))
    assert config.ingest_config(loaded) == IngestConfig(include_ids=(7,), discover=DiscoverConfig(enabled=True, top_k=4), max_items=9)


def test_items_argument(spark, tmp_path):
    assert rows(landing.resolve_items(spark, "3, 1"), "item_id") == [(3,), (1,)]
    assert rows(landing.resolve_items(spark, f"@{tmp_path}/none.json", (8,)), "item_id") == [(8,)]
    assert rows(landing.resolve_items(spark, "x", (8,)), "item_id") == [(8,)]


def test_scratch_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(named or "/tmp/barloom-")


def test_scratch_uses_the_cluster_folder_and_foreign_directory(tmp_path):
    """A fresh process elsewhere: the named folder is used, and the fitted smoother needs
    no installed package on the workers."""
    script = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {json.dumps(ROOT)})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
            "spark.checkpoint.dir", {json.dumps(str(tmp_path / "shared"))}).getOrCreate()
        from barloom.session import scratch_path
        from barloom.operators import backtest
        assert scratch_path(spark, "x").startswith({json.dumps(str(tmp_path / "shared"))}), scratch_path(spark, "x")
        series = spark.range(15).selectExpr("1L AS item_id", "date_add(date'2024-01-01', CAST(id AS INT)) AS date", "CAST(id AS DOUBLE) AS price")
        assert backtest.backtest_scores(series, ("ets",), window=12).count() == 3
        print("fine")
    """)
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "fine" in out.stdout, out.stderr[-2000:]
