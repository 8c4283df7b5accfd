"""JSON validity, prompt rendering and canonical config against Python itself;
typed CSV keeps what a sample would lose."""

import hashlib
import json

from pyspark.sql import functions as F

from arbiter.functions import hashing, json_fns, prompts
from arbiter.functions.judge import parse_judge
from arbiter.sources.tables import typed_csv


def loads_ok(t):
    try:
        json.loads(t)
        return True
    except (ValueError, TypeError):
        return False


def test_json_validity_matches_python(spark):
    texts = ['{"a":1}', '{"a":1} Hope this helps!', '{"k":1} junk', "[1,2]", "1,2", '"x"', "", " ", "{", "null", "1 2",
             '{"a":1}{"b":2}', '{"a":1},{"b":2}', '  {"a": [1, {"b": null}]}  ', "not json", None, "}{", '"a":1', "[1]]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: bool(r.ok) for r in df.select("i", json_fns.is_json("t").alias("ok")).collect()}
    assert got == {i: loads_ok(t) for i, t in enumerate(texts)}


def test_trailing_text_is_not_scored(spark):
    good = '{"helpfulness": 5, "faithfulness": 4, "conciseness": 3, "safety": 5, "reasoning": "r"}'
    df = spark.createDataFrame([(0, good), (1, good + " Hope this helps!"), (2, f"```json\n{good}\n```"), (3, None)],
                               "i int, judge_raw string")
    assert {r.i: r.judge_ok for r in parse_judge(df).collect()} == {0: True, 1: False, 2: True, 3: False}
    args = spark.createDataFrame([('{"k":1}',), ('{"k":1} junk',)], "a string").select(json_fns.tool_args("a").alias("m"))
    assert [r.m for r in args.collect()] == [{"k": "1"}, {}]


def test_render_is_one_pass(spark):
    df = spark.createDataFrame([
        ("{{a}} and {{b}}", {"a": "{{b}}", "b": "x"}), ("{{a}}{{a}}", {"a": "1"}), ("{ {{missing}} }", {"a": "1"}),
        ("plain", {}), ("{{a}}", {"a": None}), ("", {"a": "1"}), ("{{a}}$1\\{{b}}", {"a": "\\", "b": "$0"})],
        "t string, v map<string,string>")
    got = [r.r for r in df.select(prompts.render("t", "v").alias("r")).collect()]
    assert got == ["{{b}} and x", "11", "{ {{missing}} }", "plain", "{{a}}", "", "\\$1\\$0"]


def test_canonical_config_is_python_json(spark):
    rows = [("n", "1", 'sys "q" \\ \n\t\x01\x7f', "m", 0.3, 512, [("user", "hé"), ("assistant", None)]),
            ("naïve 🙂", None, None, "模型", 0.0001, None, []), ("b", "2", "", "m/x", 1e-05, 1, [("u", "\b\f\r")]),
            ("c", "3", "é", "m", 1e16, 2, []), ("d", "4", "s", "m", 12345678.5, 2, []), ("e", "5", "s", "m", None, 2, []),
            ("f", "6", "s", "m", 1.5e-07, 2, []), ("g", "7", "s", "m", 2.0, 2, []), ("h", "8", "s", "m", 1e7, 2, []),
            ("i", "9", "s", "m", 1.5e22, 2, []), ("j", "10", "s", "m", -0.00025, 2, [])]
    df = spark.createDataFrame(rows, "name string, version string, system string, model string, temperature double, "
                                     "max_tokens int, few_shots array<struct<role:string,content:string>>")
    got = {r.name: (r.c, r.h) for r in df.select(
        "name", hashing.canonical_config(df).alias("c"), hashing.config_hash(df).alias("h")).collect()}
    for name, version, system, model, temperature, max_tokens, shots in rows:
        want = json.dumps({"name": name, "version": version, "system": system, "model": model, "temperature": temperature,
                           "max_tokens": max_tokens, "few_shots": [{"role": r, "content": c} for r, c in shots]},
                          sort_keys=True)
        assert got[name] == (want, hashlib.sha256(want.encode()).hexdigest()[:12])


def test_typed_csv_keeps_late_values_and_reports_misfits(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("id,x\n" + "".join(f"{i},{i}\n" for i in range(5000)) + "5000,3.5\n5001,oops\n5002,\n")
    df = typed_csv(spark, path, {"id": "bigint", "x": "double"})
    assert df.count() == 5003
    assert df.where("id = 5000").first().x == 3.5
    assert [(r.id, list(r.rejected)) for r in df.where(F.size("rejected") > 0).collect()] == [(5001, ["x"])]
