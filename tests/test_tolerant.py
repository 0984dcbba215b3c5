"""Landing feeds that differ from what is declared."""

import os

from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import landing, tolerant

DDL = "id string, email string, n int"
ORDERS = "id string, n int, at date, ls array<struct<p:int,sub:struct<a:int>>>"


def _files(spark, **files):
    path = scratch_path(spark, "test/tolerant")
    for name, text in files.items():
        os.makedirs(f"{path}/{name}")
        with open(f"{path}/{name}/part.txt", "w", newline="") as f:
            f.write(text)
    return path


def _by(df, *cols):
    return sorted(([r[c] for c in cols] for r in df.collect()), key=str)


def test_csv_by_each_files_own_header(spark):
    path = _files(spark, a='id,email,n\nC1," a, b ",1\nC2,,x\nbroken,1\n\nC3,é,3,4\n',
                  b='﻿EMAIL, extra ,ID,extra\r\nq@x,1,D1,2\r\nEMAIL, extra ,ID,extra\r\n', c="id,email,n\n", d="n\n7\n")
    got = tolerant.read_csv(spark, path, DDL)
    assert got.columns == ["id", "email", "n", *tolerant.EXTRA_COLUMNS]
    assert _by(got, "id", "email", "n", "_rescued", "_corrupt") == sorted([
        ["C1", " a, b ", 1, None, None], ["C2", None, None, {"n": "x"}, None], [None, None, None, None, "broken,1"],
        [None, None, None, None, "C3,é,3,4"], ["D1", "q@x", None, {"extra": "1", "extra#2": "2"}, None], [None, None, 7, None, None]], key=str)
    counts = {os.path.basename(os.path.dirname(r["_file"])): (r["records"], r["broken"]) for r in tolerant.broken_by_file(got).collect()}
    assert counts == {"a": (4, 2), "b": (1, 0), "d": (1, 0)}
    assert tolerant.sound(got).columns == ["id", "email", "n", "_rescued"] and tolerant.sound(got).count() == 4


def test_csv_without_a_line(spark):
    assert tolerant.read_csv(spark, _files(spark, a=""), DDL).collect() == []


def test_csv_agrees_with_the_strict_reader_on_declared_files(spark):
    df = spark.createDataFrame([(f"C{k}", [" x ", "", None, 'q"u', "a,b", "b\\s"][k % 6], k) for k in range(60)], DDL)
    path = scratch_path(spark, "test/csv")
    landing.write_csv(df.repartition(3), path)
    strict = landing.read_csv(spark, path, DDL)
    assert _by(tolerant.read_csv(spark, path, DDL), "id", "email", "n") == _by(strict, "id", "email", "n")


def test_json_lines_lose_nothing(spark):
    path = _files(spark, a='{"id":"a","n":1,"z":{"k":[1,2]},"at":"2026-07-01"}\n{"ID":"b","n":1.5,"ls":[],"at":"soon"}\nnope {\n'
                  '{"id":7,"n":99999999999999}\n[1]\n{"id":"d","Id":"e","n":null}\n{}\n',
                  b='{"id":"f","ls":[{"p":1,"q":2}]}\n{"id":"g","ls":[{"p":1,"sub":{"a":1,"new":2}},{"p":2}]}\n{"id":"h","ls":[{"p":1,"sub":{"a":1}}]}\n{"id":"i","ls":3}\n')
    got = tolerant.read_json_lines(spark, path, ORDERS)
    rows = {r["id"] or r["_corrupt"]: r for r in got.collect()}
    assert rows["a"]["_rescued"] == {"z": '{"k":[1,2]}'} and rows["a"]["n"] == 1 and str(rows["a"]["at"]) == "2026-07-01"
    assert rows["b"]["_rescued"] == {"n": "1.5", "at": "soon"} and rows["b"]["ls"] == []
    assert rows["7"]["_rescued"] == {"n": "99999999999999"}
    assert rows["d"]["_rescued"] is None and rows["h"]["_rescued"] is None
    assert rows["f"]["_rescued"] == {"ls": '[{"p":1,"q":2}]'} and rows["f"]["ls"][0]["p"] == 1
    assert set(rows["g"]["_rescued"]) == {"ls"} and rows["g"]["ls"][1]["p"] == 2
    assert rows["i"]["_rescued"] == {"ls": "3"} and rows["i"]["ls"] is None
    assert got.where("_corrupt is not null").count() == 2 and got.count() == 11


def test_json_pages(spark):
    path = _files(spark, a='[{"id":"a","n":1},{"id":"b","x":2},5]\n[{"id": broken\n[]\n')
    got = tolerant.read_json_pages(spark, path, "id string, n int")
    assert _by(got, "id", "n", "_rescued", "_corrupt") == sorted([
        ["a", 1, None, None], ["b", None, {"x": "2"}, None], [None, None, None, "5"], [None, None, None, '[{"id": broken']], key=str)


def test_drift(spark):
    path = _files(spark, a='{"id":"a","n":1,"gone":null,"ls":[{"p":1,"q":{"r":true}}]}\nnope\n[3]\n', b='{"ID":"b","n":1.5,"ls":[{"p":"x"}]}\n')
    got = tolerant.schema_drift(spark, path, "id string, n int, gone double, ls array<struct<p:int>>, f double")
    assert {r["field"]: (r["declared"], r["observed"], r["drift"]) for r in got.collect()} == {
        "id": ("text", "text", "none"), "n": ("integer", "fraction", "widened"), "gone": ("fraction", "null", "absent"),
        "f": ("fraction", None, "absent"), "ls": ("list", "list", "none"), "ls[]": ("record", "record", "none"),
        "ls[].p": ("integer", "mixed", "changed"), "ls[].q": (None, "record", "new"), "ls[].q.r": (None, "boolean", "new")}
    nothing = tolerant.schema_drift(spark, _files(spark, a="nope\n"), "id string")
    assert [tuple(r) for r in nothing.collect()] == [("id", "text", None, "absent")]
    pages = tolerant.schema_drift(spark, _files(spark, a='[{"id":1},{"k":2}]\n'), "id int", pages=True)
    assert {r["field"]: r["drift"] for r in pages.collect()} == {"id": "none", "k": "new"}


def test_one_scan_and_no_python(spark):
    path = _files(spark, a="id,email,n\nC1,x,1\n")
    plan = tolerant.read_csv(spark, path, DDL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan
    assert tolerant.read_json_lines(spark, path, DDL).select(F.col("id"))._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_side_is_broadcast_by_rows_and_bytes(spark):
    from tessera.operators.joins import broadcast_if_small, small_enough
    df = spark.createDataFrame([(k, "x" * 100) for k in range(50)] + [(None, None)], "k int, text string")
    assert small_enough(df) and small_enough(df.limit(0)) and not small_enough(df, max_rows=50) and not small_enough(df, max_bytes=4000)
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, max_bytes=10))


def test_large_file_lists_are_joined_all_the_same(spark, monkeypatch):
    import tessera.sources.tolerant as t
    path = _files(spark, a="id,email,n\nC1,x,1\n", b="n,id\n2,C2\n")
    want = _by(t.read_csv(spark, path, DDL), "id", "email", "n")
    monkeypatch.setattr(t, "broadcast_if_small", lambda df: df)
    assert _by(t.read_csv(spark, path, DDL), "id", "email", "n") == want == [["C1", "x", 1], ["C2", None, 2]]
