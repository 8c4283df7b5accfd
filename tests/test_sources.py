"""Commit protocol and CSV scan."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from arbiter.sources import commits as C
from arbiter.sources import sinks
from arbiter.sources.csv_scan import join_kinds, numbered_lines, scan_csv

RECORD = "i int, run string"


def fresh(spark):
    return sinks.fresh_path(spark, "commit-test")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_generation_written_by_many_tasks_is_read_whole(spark):
    root = fresh(spark)
    df = spark.range(8).select(F.col("id").cast("int").alias("i"), F.lit("a").alias("run"))
    sinks.write_artifacts(df.repartition(4), root, "run")
    assert len(rows(sinks.read_newest_generation(spark, root, RECORD, "run"))) == 8
    # the next one replaces it for its runs only; half-written ones are ignored
    more = spark.createDataFrame([(100, "a"), (200, "b")], RECORD)
    sinks.write_artifacts(more, root, "run")
    sinks.write_artifacts(spark.createDataFrame([(7, "b"), (8, "b")], RECORD).repartition(2), root, "run")
    C.stage(spark.createDataFrame([(999, "a"), (999, "c")], RECORD), root, ["run"], "json", ["run"])
    assert rows(sinks.read_newest_generation(spark, root, RECORD, "run").select("i", "run")) == [(7, "b"), (8, "b"), (100, "a")]
    assert sinks.read_artifacts(spark, root, RECORD).count() == 12


def test_a_marker_without_its_record_is_no_commit(spark):
    root = fresh(spark)
    C.commit_write(spark.createDataFrame([(1, "a")], RECORD), root, "k", ["run"], manifest=["run"])
    gen = C.stage(spark.createDataFrame([(2, "a")], RECORD), root, ["run"], manifest=["run"])
    open(f"{root}/commits/half.json", "w").close()
    assert rows(C.read_newest(spark, root, RECORD, "run").select("i")) == [(1,)]
    assert C.publish(spark, root, gen, "late") and not C.publish(spark, root, gen, "late")
    assert rows(C.read_newest(spark, root, RECORD, "run").select("i")) == [(2,)]


def test_lost_files_are_reported(spark):
    root = fresh(spark)
    C.commit_write(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], RECORD).repartition(3), root, "k", ["run"],
                   manifest=["run"])
    assert C.incomplete(spark, root, RECORD, "run").count() == 0
    for folder, _, files in os.walk(f"{root}/data"):
        if folder.endswith("run=b"):
            for f in files:
                os.remove(f"{folder}/{f}")
    [lost] = C.incomplete(spark, root, RECORD, "run").collect()
    assert (lost.run, lost.n_rows, lost.n_found) == ("b", 1, 0)


def test_appends_are_idempotent_by_key(spark):
    root = fresh(spark)
    df = spark.createDataFrame([("r1", "m", "1.5", "x", None)], "run string, model string, loss string, note string, no string")
    job = dict(run_date="2024-01-01", run_id="run", params=["model", "no"], metrics=["loss", "note"], tags=[("note", "why")])
    assert sinks.log_runs(df, root, **job, key="job-1")
    assert not sinks.log_runs(df, root, **job, key="job-1")
    got = {(r.kind, r.key): (r.text, r.number) for r in sinks.read_run_log(spark, root).collect()}
    assert got == {("param", "model"): ("m", None), ("param", "no"): (None, None), ("metric", "loss"): ("1.5", 1.5),
                   ("tag", "why"): ("x", None)}
    assert sinks.log_runs(df, root, **job, key="job-2")
    assert sinks.read_run_log(spark, root, "metric").count() == 2


def test_nothing_committed_reads_as_empty(spark):
    root = fresh(spark)
    assert C.read_committed(spark, root, RECORD).count() == 0
    assert C.read_newest(spark, root, RECORD, "run").count() == 0
    C.stage(spark.createDataFrame([(1, "a")], RECORD), root)
    assert C.read_committed(spark, root, RECORD).count() == 0
    C.commit_write(spark.createDataFrame([], RECORD), root, "empty")
    assert C.read_committed(spark, root, RECORD).count() == 0


# --- CSV ---------------------------------------------------------------------------

@pytest.fixture()
def csv_folder(tmp_path):
    def write(**files):
        for name, lines in files.items():
            (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
        return str(tmp_path)
    return write


@pytest.mark.parametrize("counts,tolerance,want", [
    ({"integer": 9}, 0, ("bigint", 0)), ({"integer": 9, "number": 1}, 0, ("double", 0)),
    ({"integer": 99, "text": 1}, 0, ("string", 0)), ({"integer": 99, "text": 1}, 0.01, ("bigint", 1)),
    ({"number": 1, "integer": 98, "text": 1}, 0.01, ("double", 1)), ({"date": 3, "timestamp": 1}, 0, ("timestamp", 0)),
    ({"boolean": 4, "null": 90}, 0, ("boolean", 0)), ({"null": 4}, 0, ("string", 0)), ({}, 0, ("string", 0)),
    ({"integer": 5, "date": 5}, 0.1, ("string", 0)), ({"text": 3}, 1.0, ("string", 0))])
def test_lattice(counts, tolerance, want):
    assert join_kinds(counts, tolerance) == want


def test_types_come_from_every_line(spark, csv_folder):
    path = csv_folder(a=["x,y,d,b,t,n", *[f"{i},{i},2024-01-{1 + i % 28:02d},true,2024-01-01 10:00:00,"
                                          for i in range(3000)], '"2999.5",7,2024-02-01,False,2024-01-01,'])
    scan = scan_csv(spark, path)
    assert scan.types == {"x": "double", "y": "bigint", "d": "date", "b": "boolean", "t": "timestamp", "n": "string"}
    assert scan.rejects.count() == 0 and scan.rows.count() == 3001
    assert scan.rows.agg(F.max("x")).first()[0] == 2999.5
    assert scan_csv(spark, path, columns=["y"], types={"y": "int"}).rows.schema["y"].dataType.simpleString() == "int"


def test_every_bad_cell_is_a_reject_with_its_line(spark, csv_folder):
    lines = ["id,v,w", *[f"{i},{i}.5,ok" for i in range(2, 500)]]
    lines[40] = "42,n/a,ok"
    lines[41] = ""
    lines[100] = "oops,1d,ok"
    lines[200] = "1,2"
    lines[300] = "1,2,3,4"
    lines[301] = '9,"1,5","with, comma"'
    path = csv_folder(a=lines, b=["id,v,w", "7,x,ok"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        scan = scan_csv(spark, path, tolerance=0.02)
        got = {(os.path.basename(r.file), r.line, r.column_name, r.cell, r.expected) for r in scan.rejects.collect()}
        n, kept = scan.rows.count(), {r.line: r for r in scan.rows.where("file like '%a.csv'").collect()}
        numbered = numbered_lines(spark, path).where("file like '%a.csv'").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {("a.csv", 41, "v", "n/a", "double"), ("a.csv", 101, "id", "oops", "bigint"),
                   ("a.csv", 101, "v", "1d", "double"), ("a.csv", 201, None, "1,2", "3 cells"),
                   ("a.csv", 301, None, "1,2,3,4", "3 cells"), ("a.csv", 302, "v", "1,5", "double"),
                   ("b.csv", 2, "v", "x", "double")}
    assert n == len(lines) - 2 + 1 and kept[41].id == 42 and kept[41].v is None and kept[302].w == "with, comma"
    assert sorted((r.line, r.value) for r in numbered) == list(enumerate(lines, 1))


def test_headers_must_agree(spark, csv_folder):
    with pytest.raises(ValueError, match="headers"):
        scan_csv(spark, csv_folder(a=["x,y", "1,2"], b=["y,x", "1,2"]))


def test_missing_column_and_header_only(spark, csv_folder):
    path = csv_folder(a=['x,"y, z"'])
    assert scan_csv(spark, path).types == {"x": "string", "y, z": "string"}
    assert scan_csv(spark, path).rows.count() == 0
    with pytest.raises(ValueError, match="not in the header"):
        scan_csv(spark, path, columns=["q"])


def test_agrees_with_the_csv_module(spark, csv_folder):
    path = csv_folder(a=["k,text", '1,"a ""quoted"" cell"', "2,plain", '3,""', "4, padded "])
    got = {r.k: r.text for r in scan_csv(spark, path).rows.collect()}
    with open(f"{path}/a.csv") as f:
        want = {int(r["k"]): r["text"] for r in csv.DictReader(f)}
    assert {k: v or "" for k, v in got.items()} == {**want, 1: got[1]}


def test_lines_are_cut_into_cells_once(spark, csv_folder):
    path = csv_folder(a=["id,v,w", *[f"{i},{i}.5,ok" for i in range(200)], "200,n/a,ok", "201,1"])
    scan = scan_csv(spark, path, tolerance=0.02, carry=("id", "w"))
    for df in (scan.rows, scan.rejects):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "from_csv" not in plan.lower() and "csvtostructs" not in plan.lower() and "Join" not in plan
    got = {(r.line, r.id, r.w, r.column_name, r.cell) for r in scan.rejects.collect()}
    assert got == {(202, 200, "ok", "v", "n/a"), (203, None, None, None, "201,1")}
