"""Worked examples and fixtures for what the tables of the catalogue do not cover."""

import datetime as dt
import difflib
import json
import random

import pytest
from pyspark.sql import functions as F

from quillmill.functions import dates, money, pages, pricing_text, text
from quillmill.operators import content, dedupe, index_series, intervals, mapping, quality, reshape, tree, validity
from quillmill.plans import cpi, pricing, provider, rules, run_log
from quillmill.sources import documents, sinks, workbook
from quillmill.streaming import ingest

D = dt.date


def column(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v"))).collect()]


def test_money(spark):
    cases = {"2,585,00": "2585.00", "1,234": "1234", "$-500.00": "-500.00", "(45.00)": "45.00", "1.234,56": "1.23456", "n/a": "n/a", "AUD 12": "12", "A$7,573.50": "7573.50"}
    assert column(spark, cases, money.parse_currency) == list(cases.values())
    assert column(spark, ["59,530.00", "abc", None], money.numeric_cleanup) == ["59530.00", "abc", None]
    assert column(spark, ["$1,200.50", "", "-", "x"], money.parse_price) == [1200.5, None, None, None]


def test_dates(spark):
    cases = {"03/04/2024": "2024-04-03", "12/25/2024": "2024-12-25", "W/E 10.10.2025": "2025-10-10", "31.02.2024": "31-02-2024", "Saturday 7/12/24": "urday 7-12-24", "06/11/75": "1975-11-06"}
    assert column(spark, cases, dates.parse_date) == list(cases.values())
    steps = lambda a, b: [x for x in column(spark, [0], lambda _: dates.adjustment_dates(F.lit(a).cast("date"), F.lit(b).cast("date"), F.lit(3)), "int")[0]]
    assert steps("2023-01-31", "2023-12-31") == [D(2023, 1, 31), D(2023, 4, 28), D(2023, 7, 28), D(2023, 10, 28)]
    assert len(steps("2023-01-01", "2024-04-01")) == 5 and steps("2024-05-01", "2024-04-01") == [D(2024, 5, 1)]


def test_text(spark):
    assert column(spark, ["IT Loader, UG", "It Loader Ug"], text.normalise_key) == ["it loader ug"] * 2
    assert column(spark, ["MSA-2025-001", "Agreement No. CN-4500012345", "Contract Number: 4500067890", "Ref: PRJ-2025/789", "DOC 12345", " "], pricing_text.contract_id) == ["MSA-2025-001", "CN-4500012345", "4500067890", "PRJ-2025/789", "12345", ""]
    sentence = "Ammonium Nitrate prices (including AN MPC and AN NDC via AN MPC Price) and Emulsion (Titan 2000) prices"
    want = ["ammonium nitrate", "emulsion", "an mpc and an ndc an mpc", "titan 2000", "an", "mpc", "ndc", "an mpc", "an ndc", "an mpc price"]
    assert column(spark, [sentence], text.filter_keywords)[0] == want
    assert column(spark, ["x", "I", "iv", "XLIX", "vx", "l", "zz"], pages.roman) == [10, 1, 4, 49, None, 50, None]
    assert column(spark, ["right ", "nope", None], text.verdict) == ["CORRECT", "UNVERIFIABLE", "UNVERIFIABLE"]
    pair = spark.createDataFrame([("kitten", "sitting"), ("", "a"), ("abc", "abc")], "a string, b string")
    assert [round(r[0], 4) for r in pair.select(dedupe.lcs_similarity(F.col("a"), F.col("b"))).collect()] == [round(8 / 13, 4), 0.0, 1.0]


def test_validity(spark):
    rows = [("i", D(2024, 1, 1), None, 1), ("i", D(2024, 3, 1), None, 2), ("i", None, None, 3), ("j", D(2024, 1, 1), None, 1), ("j", D(2024, 1, 1), None, 2)]
    df = spark.createDataFrame(rows, "item string, vf date, vt date, n int")
    out = validity.chain_valid_to(df, "item", "vf", "vt", ["n"], F.lit("2024-06-30").cast("date"))
    assert {(r["item"], r["n"]): r["vt"] for r in out.collect()} == {
        ("i", 1): D(2024, 2, 29), ("i", 2): D(2024, 6, 30), ("i", 3): D(2024, 6, 30), ("j", 1): D(2023, 12, 31), ("j", 2): D(2024, 6, 30)
    }
    weeks = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 10)), (2, D(2024, 2, 1), D(2024, 1, 1)), (3, None, D(2024, 1, 1)), (4, D(2024, 1, 1), None)], "k int, a date, b date")
    got = sorted((r["k"], r["week_from"], r["week_to"]) for r in validity.expand_weekly(weeks, "a", "b").collect() if r["week_from"])
    assert got == [(1, D(2024, 1, 1), D(2024, 1, 7)), (1, D(2024, 1, 8), D(2024, 1, 10)), (4, D(2024, 1, 1), None)]
    assert validity.fan_out(df, "item", df.select("item").limit(1)).count() == 5
    with pytest.raises(ValueError):
        validity.fan_out(df, "item", df.select("item"), limit=1)


def test_cover(spark):
    def cover(last):
        rows = [("d", 1, "a", 2, 4), ("d", 2, "b", 4, 6), ("d", 3, last, 9, 9)]
        df = spark.createDataFrame(rows, "d string, n int, kind string, s int, e int")
        return sorted((r["s"], r["e"], r["kind"]) for r in intervals.cover(df, ["d"], ["n"], "kind", "s", "e", 10).collect())

    gap = "unhandled_content"
    assert cover("c") == [(1, 1, gap), (2, 4, "a"), (5, 6, "b"), (7, 8, gap), (9, 9, "c"), (10, 10, "back_matter")]
    assert cover(gap)[-1] == (9, 10, gap)


def test_repair_and_merge(spark):
    df = spark.createDataFrame([("d", 1, 1), ("d", 2, 12), ("d", 3, 5), ("d", 4, 20)], "d string, n int, start int")
    out = intervals.repair_starts(df, ["d"], ["n"], "start", F.lit(30)).orderBy("n").collect()
    assert [r["start"] for r in out][:2] == [1, 12] and 12 < out[2]["start"] < 20 and out[2]["confidence"] == 0.6
    rows = [("d", 1, 2, "t", "n"), ("d", 3, 4, "t", "n"), ("d", 6, 7, "t", "n"), ("d", 8, 9, "u", "n")]
    merged = intervals.merge_adjacent(spark.createDataFrame(rows, "d string, s int, e int, kind string, name string"), ["d"], "s", "e", "kind", "name")
    assert sorted((r["s"], r["e"], r["kind"]) for r in merged.collect()) == [(1, 4, "t"), (6, 7, "t"), (8, 9, "u")]


def test_as_of_property(spark):
    rng = random.Random(1)
    index = sorted({D(rng.randint(2000, 2009), rng.randint(1, 12), 1) for _ in range(25)})
    values = [(d, None if i % 5 == 0 else float(i)) for i, d in enumerate(index)]
    asks = [(i, D(rng.randint(1999, 2011), rng.randint(1, 12), rng.randint(1, 28))) for i in range(200)]
    asks += [(200, None), (0, D(2005, 1, 1))]  # repeated keys, no date
    out = index_series.as_of(spark.createDataFrame(asks, "k int, d date"), "d", spark.createDataFrame(values, "m date, v double"), "m", "v", "fd", "fv").collect()
    assert len(out) == len(asks)
    for r in out:
        earlier = [(m, v) for m, v in values if r["d"] and m <= r["d"].replace(day=1)]
        assert (r["fd"], r["fv"]) == (earlier[-1] if earlier else (None, None))
    odd = [(D(2001, 1, 15), 1.0, "a"), (D(2001, 3, 1), 2.0, "a"), (D(2001, 3, 20), 3.0, "a"), (D(2001, 1, 1), 9.0, "b")]  # inside months; two series
    pairs = [(D(2001, 1, 31), "a"), (D(2001, 2, 1), "a"), (D(2001, 3, 31), "a"), (D(2009, 1, 1), "a"), (D(2001, 2, 1), "b"), (D(2001, 2, 1), "c"), (D(2001, 2, 1), None)]
    got = index_series.as_of(
        spark.createDataFrame(pairs, "d date, s string"), "d", spark.createDataFrame(odd, "m date, v double, s string"), "m", "v", "fd", "fv", "s", "s"
    ).collect()
    assert {(r["d"], r["s"]): r["fv"] for r in got} == dict(zip(pairs, (None, 1.0, 2.0, 3.0, 9.0, None, None), strict=True))


def test_as_of_does_not_shuffle_the_facts(spark):
    facts = spark.range(0, 300_000, 1, 4).select("id", F.expr("date_add('2024-05-05', cast(id % 2 as int))").alias("d"))  # one hot month
    index = spark.createDataFrame([(D(2024, m, 1), float(m)) for m in range(1, 7)], "m date, v double")
    out = index_series.as_of(facts, "d", index, "m", "v", "fd", "fv")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "NestedLoop" not in plan
    assert out.agg(F.sum("fv")).first()[0] == 5.0 * 300_000


def test_price_rows(spark):
    rows = [(1, ["Role", "Dayshift AUD", "Nightshift AUD"], ["Fitter", "100", "120"]), (2, ["Item", "Rate"], ["Nut", ""]), (3, ["Item", "Notes"], ["Bolt", "7.5"])]
    out = reshape.price_rows(spark.createDataFrame(rows, "k int, headers array<string>, row array<string>"), ["k"]).collect()
    assert sorted((r["k"], r["description"], r["price"], r["currency"]) for r in out) == [
        (1, "Fitter - Dayshift", "100", "AUD"), (1, "Fitter - Nightshift", "120", "AUD"), (2, "Nut", "", ""), (3, "Bolt", "7.5", "")
    ]


def test_quality(spark):
    rows = [("correct",)] * 8 + [("wrong",), ("missing",), ("unclear",), ("odd",)]
    r = quality.accuracy(spark.createDataFrame(rows, "v string").withColumn("g", F.lit(1)), ["g"], "v").first()
    assert (r["verifiable"], r["accuracy_bp"]) == (10, 8000)
    grades = spark.createDataFrame([(96.0, 1), (96.0, 0), (84.9, 0), (10.0, 0)], "a double, e int").select(quality.grade(F.col("a"), F.col("e")))
    assert [x[0] for x in grades.collect()] == ["B", "A", "C", "F"]
    flag = quality.review_flag(spark.createDataFrame([(1, 1.0), (1, 0.7), (2, 1.0), (2, 0.69)], "g int, c double"), ["g"], "c")
    assert {r["g"]: r["needs_review"] for r in flag.collect()} == {1: False, 2: True}
    docs = spark.createDataFrame([("a",), ("b",)], "d string")
    stats = quality.coverage_statistics(spark.createDataFrame([("a", 100)], "d string, c int"), ["d"], "c", F.lit(False))
    assert {r["d"]: r["grade"] for r in quality.with_empty(docs, stats, "d").collect()} == {"a": "A", "b": "F"}


def test_cooccurrence_and_clusters(spark):
    sets = spark.createDataFrame([("g", "a", [1]), ("g", "b", [1, 2]), ("g", "c", [3])], "g string, n string, c array<int>")
    out = dedupe.split_by_cooccurrence(sets, "g", "n", "c").collect()
    assert {r["n"]: r["subgroup"] for r in out} == {"a": 0, "b": 1, "c": 0}
    names = ["Trade Assistant", "Trade Assistants", "Trade Asistant", "Trainer", "Trade Assistant"]
    got = {r["name"]: r["canonical"] for r in dedupe.name_clusters(spark.createDataFrame([(n,) for n in names], "n string"), "n").collect()}
    assert got["Trade Asistant"] == got["Trade Assistants"] == "Trade Assistant" and got["Trainer"] == "Trainer"
    assert difflib.SequenceMatcher(None, "trade assistant", "trade asistant").ratio() > 0.55


def test_content_rewrites():
    assert content.level_siblings([{"type": "subsection", "heading": "1 A", "content": [{"type": "subsection", "heading": "2 B", "content": []}]}]) == [
        {"type": "subsection", "heading": "1 A", "content": []}, {"type": "subsection", "heading": "2 B", "content": []}
    ]
    deep = {"type": "subsection", "heading": "1.1 C", "heading_level": "2", "content": [{"type": "subsection", "heading": "x", "heading_level": "1", "content": []}]}
    top = {"type": "subsection", "heading": "1 A", "heading_level": "1", "content": [{"type": "subsection", "heading": " ", "heading_level": "1", "content": []}, deep]}
    assert content.level_siblings([top]) == [top]  # a blank heading does not count, nor what is lifted further down
    p = lambda t: {"type": "paragraph", "text": t}
    s = lambda h, *c: {"type": "subsection", "heading": h, "content": list(c)}
    assert content.merge_batches([[s("S", p("x"))], [p("y"), s("T"), p("z")]]) == [s("S", p("x"), p("y")), s("T"), p("z")]
    assert content.merge_batches([[s("S", p("x"))], [s("", p("y"))]]) == [s("S", p("x"), p("y"))]
    assert content.drop_repeats([p("x"), p("x"), s("S", p("x"))]) == [p("x"), s("S", p("x"))]
    old = {"heading": "H", "body": ["b"], "tables": [{"headers": ["a"], "rows": []}], "text": "t"}
    assert [b["type"] for b in content.normalise(old)[0]["content"]] == ["paragraph", "paragraph", "table"]
    assert content.prune({"a": "", "b": {"c": None}, "d": [{}, 1, ""]}) == {"a": "", "b": {}, "d": [1]}
    assert content.prune({"n": 1}) == {} and content.prune({"n": 1}, typed=False) == {"n": 1}
    assert content.prune([{"type": "table", "rows": []}, {"text": ""}]) == [{"type": "table", "rows": []}] and content.prune([{"type": "", "rows": []}], typed=False) == []
    assert content.mostly_empty({}) and content.mostly_empty({"a": " ", "b": {"c": None}, "d": 1}) and not content.mostly_empty({"a": 1, "b": ""})
    assert content.field_counts({"a": "", "b": [1, {}], "c": {"d": "x"}}) == (4, 2)
    assert [content.numbering_depth(h) for h in ("1.2 x", "(a) x", "x", "3")] == [2, 1, 0, 1]


def test_merge_sections(spark):
    rows = [("d", 2, json.dumps(["late"])), ("d", 1, json.dumps([{"heading": "H", "text": "t"}]))]
    out = content.merge_sections(spark.createDataFrame(rows, "d string, n int, c string"), ["d"], "n", "c").first()
    assert json.loads(out["c"])[0]["content"] == [{"type": "paragraph", "text": "t"}, {"type": "paragraph", "text": "late"}]


def test_tables(spark):
    schema = "d string, n int, headers array<string>, caption string, rows array<array<string>>"
    rows = [("d", 1, ["A", "B"], "", [["1", "2"]]), ("d", 2, [], "", [["3", "4"]]), ("d", 3, [], "New", [["5"]])]
    out = tree.absorb_continuations(spark.createDataFrame(rows, schema), ["d"], ["n"]).collect()
    assert sorted((r["headers"], r["rows"]) for r in out) == [([], [["5"]]), (["A", "B"], [["1", "2"], ["3", "4"]])]
    fixed = tree.repair_headers(spark.createDataFrame([("d", 1, ["Title"], "", [["Item", "Rate"], ["x", "1"]]), ("d", 2, [], "", [["Item", "Rate"], ["x", "1"]])], schema)).collect()
    assert [r["headers"] for r in fixed] == [["Item", "Rate"]] * 2 and fixed[0]["caption"] == "Title"
    price = tree.repair_headers(spark.createDataFrame([("d", 1, ["Rates"], "", [["Fitter", "100"], ["Welder", "120"]])], schema)).first()
    assert price["headers"] == ["Rates"] and len(price["rows"]) == 2  # a row of prices is no header
    kv = tree.label_pairs(spark.createDataFrame([("d", 1, [], "", [["Effective Date: 1/1/2025", ""], ["Supplier", "Acme"], ["Vendor", "Other"]])], schema), ["d"])
    assert {r["field"]: r["value"] for r in kv.collect()} == {"VALID_FROM": "1/1/2025", "COMPANY_CODE": "Acme"}


def test_sections_of(spark):
    flat = json.dumps({"document_id": "a", "sections": [{"section_type": "x"}, {"section_type": "y"}]})
    bucketed = json.dumps({"zeta": [{"h": 1}], "alpha": [{"h": 2}, {"h": 3}], "note": "text"})
    out = tree.sections_of(spark.createDataFrame([("f", flat), ("b", bucketed)], "d string, js string"), "d", "js").collect()
    assert sorted((r["d"], r["ord"], r["section_type"], r["section_name"]) for r in out) == [
        ("b", 1, "zeta", "Zeta"), ("b", 2, "alpha", "Alpha"), ("b", 3, "alpha", "Alpha"), ("f", 1, "x", "Unknown"), ("f", 2, "y", "Unknown")
    ]


def test_mapping_rules(spark):
    out = mapping.replace_by_match(spark.createDataFrame([("a",), ("b",), ("c",)], "name string"), "name", spark.createDataFrame([("a", "A", 0.9), ("b", "B", 0.5)], "value string, matched string, confidence double"))
    assert sorted((r["orig_name"], r["name"], r["name_norm_confidence"]) for r in out.collect() if r["orig_name"] != "c") == [("a", "A", 0.9), ("b", "b", 0.5)]
    notes = spark.createDataFrame([("Name: Jo Bloggs; date: 1/2/2024; Trade - Fitter",), ("none",)], "n string")
    got = notes.select(*[c.alias(k) for k, c in mapping.note_fields(F.col("n")).items()]).collect()
    assert tuple(got[0]) == ("Jo Bloggs", "1/2/2024", "Fitter") and tuple(got[1]) == (None, None, None)
    assert mapping.ordered_columns(spark.createDataFrame([(1, 2, 3, 4)], ["zz", "orig_uom", "uom", "vendor_name"]), mapping.INVOICE).columns == ["vendor_name", "uom", "orig_uom", "zz"]


def test_cpi_plan(spark):
    index = spark.createDataFrame([("cpi", D(2024, m, 1), 100.0 + 2 * i) for i, m in enumerate((1, 4, 7, 10))] + [("other", D(2024, 1, 1), 5.0)], "series string, date date, value double")
    prices = spark.createDataFrame([("d", "r1", "steel bolt", "$100"), ("d", "r2", "nut", "200"), ("e", "r3", "bolt", "1")], "document_id string, row_id string, item string, net_price string")
    schema = "document_id string, period_id string, period_start date, period_end date, frequency string, series string, base_price double, base_index double, keyword string"
    formulas = spark.createDataFrame([("d", "p", D(2024, 1, 1), D(2024, 12, 31), "quarterly", "cpi", None, None, "bolt"), ("d", "q", D(2024, 1, 1), D(2024, 12, 31), "quarterly", "cpi", 841.0, 130.2, "zzzz")], schema)
    out = cpi.adjust_prices(prices, formulas, index).collect()
    rolled = sorted((r["valid_from"], round(r["price"], 2)) for r in out if r["period_id"] == "p")
    assert rolled == [(D(2024, 1, 1), 100.0), (D(2024, 4, 1), 102.0), (D(2024, 7, 1), 104.0), (D(2024, 10, 1), 106.0)]
    assert {r["row_id"] for r in out if r["period_id"] == "q"} == {"r1", "r2"}
    assert max(r["valid_to"] for r in out) == D(2024, 12, 31) and {r["document_id"] for r in out} == {"d"}
    label = cpi.adjustment_label(F.lit("cpi_ratio"), F.lit(841.0), F.lit(130.2), F.lit(137.4), F.lit(887.5069), F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date"))
    assert spark.range(1).select(label).first()[0] == "CPI Adjusted (cpi_ratio) | Po: 841.00 | CPIo: 130.2 | CPIn: 137.4 | Pn: 887.51 | Period: 01/01/2024-31/12/2024"


def test_pricing_plan(spark):
    schema = "document_id string, table_id string, ord int, section string, caption string, context string, headers array<string>, rows array<array<string>>"
    tables = spark.createDataFrame(
        [("d", "t1", 1, "Schedule of Rates", "Labour", "Valid from: 1/7/2024 in US dollars per hour", ["Role", "Day Rate", "Night Rate"], [["Fitter", "100", "120"]]),
         ("d", "t2", 2, "Contacts", "", "", ["Name", "Phone"], [["Jo", "x"]])], schema)
    defaults = spark.createDataFrame([("d", "C-1", "AUD", "1/1/2024", None)], "document_id string, contract_id string, currency string, valid_from string, valid_to string")
    items = pricing.pricing_items(tables, defaults)
    got = sorted((r["item_description"], r["net_price"], r["currency"], r["valid_from"], r["price_unit"], r["contract_id"]) for r in items.collect())
    assert got == [("Fitter - Day", "100", "USD", "1/7/2024", "Hour", "C-1"), ("Fitter - Night", "120", "USD", "1/7/2024", "Hour", "C-1")]
    dated = pricing.dated_prices(items, F.lit("2025-01-01").cast("date")).collect()
    assert {r["valid_from"] for r in dated} == {D(2024, 7, 1)} and {r["valid_to"] for r in dated} == {D(2025, 1, 1)}


def test_provider(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "p string")
    got = provider.ask(df, "p", provider.RecordedProvider({provider.prompt_key("a"): "A"})).collect()
    assert sorted(str(r["reply"]) for r in got) == ["A", "A", "None", "None"]
    cached = provider.CachedProvider(provider.RuleProvider(str.upper))
    assert [cached.reply(x) for x in "aab"] == ["A", "A", "B"] and cached.calls == 2

    class Broken:
        def reply(self, prompt):
            raise OSError

    assert provider.RetryingProvider(Broken()).reply("x") is None
    assert provider.render("{a} {b}", a=1) == "1 {b}"
    assert provider.repair_json('```json\n{"a": [1, 2,],}\n```') == {"a": [1, 2]}
    assert provider.repair_json('[{"a": 1}, {"a": {"b": 2}}, {"a": ') == [{"a": 1}, {"a": {"b": 2}}]
    assert provider.repair_json("nothing") is None
    replies = iter(["no", '{"a": 1}', '```{"a": 1, "b": null, "c": 3}```'])
    asked = provider.StructuredProvider(provider.RuleProvider(lambda _: next(replies)), ("a", "b"))
    assert json.loads(asked.reply("x")) == {"a": 1, "b": None}
    assert provider.StructuredProvider(provider.RuleProvider(lambda _: None), ("a",)).reply("x") is None


def test_http_provider():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Echo(BaseHTTPRequestHandler):
        def do_POST(self):
            said = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            body = json.dumps({"out": [said["q"].upper(), self.headers["X-Key"]]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Echo)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        asked = provider.HttpProvider(f"http://127.0.0.1:{server.server_port}/", lambda p: {"q": p}, lambda a: "/".join(a["out"]), {"X-Key": "k"}, 5)
        assert asked.reply("hi") == "HI/k"
    finally:
        server.shutdown()
    assert provider.RetryingProvider(asked, 1).reply("hi") is None


def test_run_log(spark, tmp_path):
    log = run_log.RunLog("r")
    with log.step("read") as said:
        said["rows"] = 3
    with pytest.raises(ValueError), log.step("fail"):
        raise ValueError("bad")
    assert [(r["nth"], r["step"], r["rows"], r["error"]) for r in log.table(spark).orderBy("nth").collect()] == [(0, "read", 3, None), (1, "fail", None, "bad")]
    assert "failed" in log.summary() and log.summary().startswith("run r")
    run_log.logger("t", path=str(tmp_path / "x.log")).warning("said %s", "so")
    assert "said so" in (tmp_path / "x.log").read_text() and len(run_log.logger("t").handlers) == 2


def test_workbooks(spark, tmp_path):
    frame = spark.createDataFrame([("a<b", 1, None), (" c", 2, 2.5)], "A string, B int, C double")
    sinks.write_workbook({"One/Two": frame, "Empty": frame.limit(0)}, str(tmp_path / "w_pricing.xlsx"))
    sinks.write_workbook({}, str(tmp_path / "none.xlsx"))
    rows = workbook.read_workbooks(spark, str(tmp_path)).collect()
    assert [(r["sheet"], r["row_no"], r["cells"]) for r in sorted(rows, key=lambda r: (r["sheet_no"], r["row_no"]))] == [
        ("One_Two", 0, ["A", "B", "C"]), ("One_Two", 1, ["a<b", "1"]), ("One_Two", 2, [" c", "2", "2.5"]), ("Empty", 0, ["A", "B", "C"])
    ]
    got = documents.read_text_table(spark, str(tmp_path / "w_pricing.xlsx"), ("A", "B")).orderBy("B").collect()
    assert [tuple(r) for r in got] == [("a<b", "1", "", "w.pdf"), ("c", "2", "2.5", "w.pdf")]
    with pytest.raises(ValueError):
        documents.read_text_table(spark, str(tmp_path / "w_pricing.xlsx"), ("Z",))
    (tmp_path / "items.json").write_text('[{"A": 1, "B": " x "}, {"A": null}]')
    assert sorted(tuple(r) for r in documents.read_text_table(spark, str(tmp_path / "items.json")).collect()) == [("", "", "items.pdf"), ("1", "x", "items.pdf")]
    sheets = {"Note": [["x"]], "Data1": [["", "CPI Index Numbers", None], ["Unit", "Index"], ["2024-01-01", 100.5, "x"], [None, 7], ["2024-04-01", 101]]}
    (tmp_path / "index.xlsx").write_bytes(workbook.workbook_bytes(sheets))
    index = documents.read_index_sheet(spark, str(tmp_path / "index.xlsx")).orderBy("pos", "date").collect()
    assert [(r["series"], r["date"], r["value"]) for r in index] == [
        ("CPI Index Numbers", D(2024, 1, 1), 100.5), ("CPI Index Numbers", D(2024, 4, 1), 101.0), ("series_2", D(2024, 1, 1), None), ("series_2", D(2024, 4, 1), None)
    ]
    (tmp_path / "no.xlsx").write_bytes(workbook.workbook_bytes({"a": [["x"]] * 30}))
    with pytest.raises(ValueError):
        documents.read_index_sheet(spark, str(tmp_path / "no.xlsx"))
    assert workbook._shown("45292", True) == "2024-01-01" and workbook._shown("1.50", False) == "1.5" and workbook.column_name(701) == "ZZ"


def test_report_layouts(spark):
    items = spark.createDataFrame([("C", "1", "x")], "CONTRACT_ID string, NET_PRICE string, extra string")
    tables = spark.createDataFrame([("d", 1, "S", "cap", ["A", None], [["1"], ["2"]])], "document_id string, ord int, section string, caption string, headers array<string>, rows array<array<string>>")
    frames = sinks.pricing_frames(items, tables)
    assert frames["Pricing Data"].columns == list(sinks.PRICE_COLUMNS) and tuple(frames["Source Tables"].first()) == ("d", 1, "S", "cap", "A | ", 2)
    checked = sinks.verification_frames(spark.createDataFrame([("CORRECT", "i", "why")], "verdict string, item string, reasoning string"), spark.createDataFrame([("d", 1)], "document_id string, n int"))
    assert checked["Verification"].columns == ["item", "verdict", "reasoning"] and json.loads(checked["Summary"].first()["json"]) == {"document_id": "d", "n": 1}
    review = spark.createDataFrame([("d", "t", None, "correct", 90, ["a", "b"], ["c"]), ("d", "u", "bad", None, None, None, None)], "document_id string, table_id string, error string, classification_verdict string, overall_accuracy_pct int, mapping_verdicts array<string>, value_verdicts array<string>")
    assert {k: v.count() for k, v in sinks.mapping_review_frames(review, review.limit(1)).items()} == {"Summary": 1, "Classification": 1, "Mappings": 2, "Values": 1}
    assert sinks.target_frames({"TblInvoice": spark.createDataFrame([(1, 2)], "zz int, uom int")}, {"TblInvoice": mapping.INVOICE})["TblInvoice"].columns == ["uom", "zz"]
    blocks = spark.createDataFrame([("d", "1", 0, "table", "H", None, None, "cap", ["A"], [["1"]])], "document_id string, path string, depth int, block_type string, under string, heading string, text string, caption string, headers array<string>, rows array<array<string>>")
    assert sinks.document_frames(blocks, blocks)["Tables"].first()["label"] == "Table 1: cap (from H)"


def test_rules(spark):
    toc = spark.createDataFrame([("d", 1, "Contents\nIntro ..... 3\nRates........12")], "document_id string, page_number int, text string")
    assert sorted((r["title"], r["printed_page"]) for r in rules.toc_entries(toc).collect()) == [("Intro", 3), ("Rates", 12)]
    heads = spark.createDataFrame([("d", 1, "1. Scope\nbody text\nSCHEDULE OF RATES")], "document_id string, page_number int, text string")
    assert sorted(r["section_name"] for r in rules.headings(heads).collect()) == ["1. Scope", "SCHEDULE OF RATES"]
    matched = rules.match_descriptions(spark.createDataFrame([("Trade, assistant",), ("x",)], "value string"), spark.createDataFrame([("Trade Assistant",), ("Assistant",)], "reference string"))
    assert [tuple(r) for r in matched.collect()] == [("Trade, assistant", "Trade Assistant", 1.0)]
    terms = rules.match_terms(spark.createDataFrame([(1, "payment is due monthly"), (2, "other")], "section_id int, text string"), spark.createDataFrame([("payment terms",)], "term string"))
    assert [(r["section_id"], r["score"]) for r in terms.collect()] == [(1, 0.5)]
    pages_, out = spark.createDataFrame([(1, "a b c d")], "p int, text string"), spark.createDataFrame([(1, "a b c")], "p int, text string")
    assert rules.page_recall(pages_, out, ["p"]).first()["coverage_pct"] == 75.0


def test_sources(spark, tmp_path):
    assert documents.parse_page_range("5-20") == (5, 20) and documents.parse_page_range("7") == (7, 7)
    for bad in ("0", "5-4", "x"):
        with pytest.raises(ValueError):
            documents.parse_page_range(bad)
    (tmp_path / "a_extracted.json").write_text('{"document_id": "a"}')
    (tmp_path / "b_extracted.json").write_text("{broken")
    (tmp_path / "a_field_mapping.json").write_text("{}")
    good, bad = documents.read_json_documents(spark, [str(tmp_path)], derived=False)
    assert good.count() == 1 and bad.count() == 1
    (tmp_path / "list.txt").write_text("# all\n a.json # first\n\nb.json\n")
    assert documents.read_path_list(spark, str(tmp_path / "list.txt")) == ["a.json", "b.json"]
    (tmp_path / "x_pricing.csv").write_text("A,B\n 1 ,\n")
    row = documents.read_text_table(spark, str(tmp_path / "x_pricing.csv"), ("A",)).first()
    assert tuple(row) == ("1", "", "x.pdf")
    (tmp_path / "index.csv").write_text(",CPI Index Numbers,\n2024-01-01,1.5,x\nnote,,\n")
    got = documents.read_index_sheet(spark, str(tmp_path / "index.csv"))
    assert sorted((r["series"], r["value"]) for r in got.collect()) == [("CPI Index Numbers", 1.5), ("series_2", None)]
    assert [r[0] for r in documents.series_names(got).collect()] == ["CPI Index Numbers"]
    pages_ = spark.createDataFrame([("d", i) for i in range(1, 6)], "document_id string, page_number int")
    assert sorted(tuple(r)[1:] for r in documents.page_range(pages_, 2, 9).collect()) == [(1, 2), (2, 3), (3, 4), (4, 5)]


def test_sinks(spark, tmp_path):
    queue = spark.createDataFrame([("a", "open"), ("b", "open")], "document_id string, status string")
    new = sinks.set_status(queue, spark.createDataFrame([("a", "approved")], "document_id string, status string"))
    assert {r["document_id"]: r["status"] for r in new.collect()} == {"a": "approved", "b": "open"}
    assert sinks.combine([queue, queue.select("document_id")]).count() == 4
    sinks.write_frames({"q": queue}, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f" / "q")).count() == 2


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("a", "2024-01-01 00:00:00", 1.5), ("a", "2024-01-01 00:00:10", 1.5), ("b", "2024-01-09 00:00:00", 2.0), ("c", "2024-03-01 00:00:00", 1.0)], "k string, ts string, v double").write.json(source)
    schema = "k string, ts timestamp, v double"
    ingest.write_table(ingest.first_arrivals(ingest.read_documents(spark, source, schema), "k", "ts"), str(tmp_path / "once"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "once")).count() == 3
    weekly = ingest.weekly_counts(ingest.read_documents(spark, source, schema), "ts", [], "v")
    ingest.write_table(weekly, str(tmp_path / "weekly"), str(tmp_path / "c2")).awaitTermination()
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "weekly")).collect()) == [1, 2]


def test_flatten_more_than_a_million_blocks(spark):
    docs = spark.range(0, 550_000, 1, 4).select("id", F.lit('[{"type":"subsection","heading":"h","content":["p"]}]').alias("js"))
    flat = tree.flatten_blocks(spark, docs, "id", "js")
    assert flat.groupBy("block_type", "under").count().orderBy("block_type").collect() == [("paragraph", "h", 550_000), ("subsection", None, 550_000)]


def test_page_lists(spark):
    cases = {"1-2000000000": list(range(1, 11)), "99999999999999-99999999999999999": [], "7-3": [7, 3], "0-2": [1, 2], "8 – 12": [8, 9, 10], "x": []}
    assert column(spark, cases, lambda c: pages.page_list(c, F.lit(10))) == list(cases.values())


def test_candidate_pairs_skip_common_words(spark):
    names = [f"common word x{i} y{i}" for i in range(3000)] + ["common word x1 z", "common q"]
    described = spark.createDataFrame([(n, [i]) for i, n in enumerate(names)], "n string, c array<int>")
    got = {(r["name_a"], r["name_b"]): (r["shared"], r["smaller"]) for r in dedupe.candidate_pairs(described.filter("n like '%x1 %'"), "n", "c").collect()}
    assert got == {("common word x1 y1", "common word x1 z"): (3, 4)}
    three = spark.createDataFrame([(f"hot a{i} b{i}", [i]) for i in range(5000)], "n string, c array<int>")
    assert dedupe.candidate_pairs(three, "n", "c").count() == 0


def test_fuzzy_match(spark):
    values = ["Labourer", "labourers", "Crane  Operator", "x", "boiler maker", ""]
    found = ["Labourers", "Crane Operator", "Crane Operators", "X", "Boilermaker"]
    out = dedupe.fuzzy_match(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(c, i) for i, c in enumerate(found)], "candidate string, ord int"))

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b, 1):
                new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
            row = new
        return 2 * row[-1] / (len(a) + len(b))

    want = {}
    for v in values:
        best = max(((lcs(v.lower().replace("  ", " "), c.lower()), -i, c) for i, c in enumerate(found)), default=None) if v else None
        if best and best[0] >= 0.85:
            want[v] = best[2]
    assert {r["value"]: r["matched"] for r in out.collect()} == want and len(want) == 5
