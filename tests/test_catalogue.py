"""Every query of the catalogue against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from quillmill.operators import intervals
from quillmill.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return str(int(x)) if isinstance(x, float) and x == int(x) else str(x)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in ORACLES:
        assert got
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(_plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in found.fetchall()), key=str)
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_clause_context_of_texts_with_markers(spark, tmp_path):
    marked = ["mail icpcpi.43@x", "card 4125346984640168", "6401", "price ADJUSTed", "CPIn/CPIo", "cPİ", "Po =", "the base price", "Rise and Fall", "Cat No.", "cpicpi", "ccpipi"]
    odd = ["plain", "", "  ", "\u00a0", " \u3000\u2009", "\t", "\r", "\u200b", "x\u00a0"]
    rows = [(7 * 11 * i + 1, "\n".join(x for k in range(6) for x in ("a", odd[(i + k) % len(odd)], marked[i % len(marked)], odd[(2 * i + k) % len(odd)], "b", "c"))) for i in range(36)]
    spark.createDataFrame([*rows, (5, None), (6, ""), (13, "cpi"), (14, "cpi")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(tuple(r) for r in QUERIES["q_clause_context"](spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(ORACLES["q_clause_context"]).fetchall()) and (14, 0) in got and (13, 0) not in got
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["a", "\u00a0", "card 4125346984640168", "b", "c"])], "d int, pos int, line string")
    near = intervals.clause_context(lines, ["d"], "pos", "line", before=1, after=1)
    assert sorted(r["pos"] for r in near.collect()) == [0, 2, 3]  # the operator itself goes by a text's own markers
