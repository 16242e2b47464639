import json

from pyspark.sql import functions as F

from quillmill.operators import counters
from quillmill.plans.settings import Settings


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "s.json").write_text(json.dumps({"a": {"b": 1}, "schemas": {"rates": [1], "unhandled_content": [2]}, "section_names": {"R": "rates"}, "heading_aliases": {"x": ["1", "2"]}}))
    s = Settings(path=str(tmp_path / "s.json"))
    assert (s.get("a.b"), s.get("a.c", 5), s.section_schema("R"), s.section_schema("?")) == (1, 5, [1], [2])
    assert s.heading_aliases() == "x: 1, 2" and Settings({}).section_schema("R") == []


def test_counters(spark):
    maps = spark.createDataFrame([("a", "A", "A", "A"), ("b", "b", "A", "A"), ("b", "b", "A", "A")], "raw string, cleaned string, merged string, final string")
    assert tuple(counters.reconcile_counters(maps).first()) == (3, 2, 2, 1, 1, 1, 1, 0, 2)
    maps = maps.limit(2)
    entries = spark.createDataFrame([("d", 1), ("d", None), ("d", 3)], "d string, page int")
    assert counters.page_mapping_coverage(entries, "page", ["d"]).first()["pct"] == 66.67
    adjusted = spark.createDataFrame([("p",), ("p",)], "period_id string")
    assert tuple(counters.adjustment_counters(maps, adjusted).first()) == (2, 2, 4, 1)
    rows = spark.createDataFrame([("t",)], "_source_table string")
    tables = spark.createDataFrame([("t",), ("u",)], "table_id string")
    assert {r["table_id"]: r["rows_made"] for r in counters.rows_by_source(rows, tables).collect()} == {"t": 1, "u": 0}


def test_formula(spark):
    js = json.dumps({"series": "CPI A | CPI B", "applies_to": "None", "frequency": "Quarterly", "Po": "12.5"})
    r = spark.createDataFrame([(js,)], "js string").select(*[c.alias(k) for k, c in counters.normalise_formula(F.col("js")).items()]).first()
    assert tuple(r) == ("CPI A", "all", "quarterly", 12.5, None)
    r = spark.createDataFrame([("", " ", "x")], "a string, b string, c string").select(counters.first_filled(F.col("a"), F.col("b"), F.col("c"))).first()
    assert r[0] == "x"
