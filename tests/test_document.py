import json

from pyspark.sql import functions as F

from quillmill.operators import content, document


def test_header_fields(spark):
    js = json.dumps({"b_header": {"vendor": {"text": "B"}, "no": "1"}, "a_header": {"vendor": "A", "due": "x"}, "sections": []})
    out = document.header_fields(spark.createDataFrame([("d", js)], "d string, js string"), "d", "js").collect()
    assert {r["field"]: r["value"] for r in out} == {"vendor": "B", "no": "1", "due": "x"}


def test_discover_tables(spark):
    js = json.dumps({"tables": [{"table_id": "t"}], "content": [{"type": "table"}, {"type": "paragraph"}], "data": {"content": [{"type": "table"}]}})
    out = document.discover_tables(spark.createDataFrame([("d", 1, js)], "d string, o int, js string"), "d", "o", "js").collect()
    assert sorted((r["layout"], r["pos"]) for r in out) == [("A", 0), ("B", 0)]


def test_context(spark):
    rows = [("d", i, k, t) for i, (k, t) in enumerate([("paragraph", "a"), ("paragraph", "b"), ("table", None), ("paragraph", "c"), ("subsection", None), ("paragraph", "z")])]
    out = document.context_around(spark.createDataFrame(rows, "d string, o int, block_type string, text string"), ["d"], "o", before=1)
    r = out.filter("block_type = 'table'").first()
    assert (r["context_before"], r["context_after"]) == ("b", "c")


def test_pages(spark):
    entries = spark.createDataFrame([("d", 1, "Rates & fees", 4), ("d", 2, "x", 1), ("d", 3, "nowhere", 1)], "document_id string, ord int, title string, printed_page int")
    pages = [("d", 2, "rates fees", True), ("d", 4, "x RATES and", False), ("d", 7, "the rates fees", False), ("d", 3, "Rates, fees", False)]
    out = document.heading_pages(entries, spark.createDataFrame(pages, "document_id string, page_number int, text string, is_toc boolean"))
    assert [r["page"] for r in out.collect()] == [7]
    df = spark.createDataFrame([([3, 5],), ([],), ([1],)], "p array<int>")
    assert [r[0] for r in df.select(document.context_pages(F.col("p"), F.lit(5))).collect()] == [[2, 3, 4, 5], [], [1, 2]]


def test_picks(spark):
    df = spark.createDataFrame([("g", "low", 1), ("g", "High", 2), ("g", "high", 3)], "g string, c string, o int")
    assert document.best_candidate(df, ["g"], "c", "o").first()["o"] == 2
    rows = spark.createDataFrame([("t", i, ["x" * 130, None]) for i in range(7)], "t string, o int, cells array<string>")
    got = document.sample_rows(rows, ["t"], "o", "cells").collect()
    assert len(got) == 5 and got[0]["cells"] == ["x" * 120 + "...", None]
    js = spark.createDataFrame([('{"a": "", "b": null, "c": "x"}',), ('{"a": "x"}',), ("{",), (None,), ("[1]",)], "js string")
    assert [r[0] for r in js.select(content.read_json(F.col("js"), "mostly_empty")).collect()] == [True, False, None, None, None]


def test_combine(spark):
    sections = spark.createDataFrame([("d", 5, "B", "t", "", "c2"), ("d", 1, "A", "t", "Head", "c1")], "document_id string, start_page int, section_name string, section_type string, heading string, content string")
    r = document.combine(sections, spark.createDataFrame([("d", "vendor", "V")], "document_id string, field string, value string")).first()
    assert r["section_names"] == ["A", "B"] and [s["heading"] for s in r["sections"]] == ["Head", "B"] and r["header"] == {"vendor": "V"}


def test_json_readers_share_a_worker(spark):
    from quillmill.queries import QUERIES

    plan = QUERIES["q_json_readers"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1  # a node, and so a worker, for each reader before
    names = ("all_text", "clause_text", "mostly_empty", "field_counts")
    texts = ['{"a": " x ", "_b": "y", "c": []}', "{", None, '["7", "long %s"]' % ("é" * content.CHUNK), '"z"', "[1"]
    js = spark.createDataFrame(list(enumerate(texts)), "i int, js string").coalesce(1).orderBy("i")
    got = js.select(content.read_json_struct(F.col("js"), names).alias("r"), *[content.read_json(F.col("js"), n).alias(n) for n in names]).collect()
    assert [r["r"] is None for r in got] == [False, True, True, False, False, True]
    assert all([r["r"] and r["r"][n] for n in names] == [r[n] for n in names] for r in got)
    assert got[0]["r"]["all_text"] == "x" and tuple(got[0]["field_counts"]) == (3, 1) and got[3]["r"]["clause_text"] == texts[3][7:-2]
