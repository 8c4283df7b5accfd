import pytest
from pyspark.sql.utils import AnalysisException  # noqa: F401

from arbiter.functions.judge import parse_judge, strict

BODY = '{"helpfulness": 5, "faithfulness": 4, "conciseness": 3, "safety": 5, "reasoning": "ok"}'


def test_parse_variants(spark):
    rows = [(1, BODY), (2, "```json\n" + BODY + "\n```"), (3, "```\n" + BODY + "\n```"),
            (4, "  \n" + BODY + "\n "), (5, "not json"), (6, '{"helpfulness": 5}'),
            (7, '{"helpfulness": 1, "faithfulness": 2, "conciseness": 2, "safety": 2}'),
            (8, '{"helpfulness": "five", "faithfulness": 2, "conciseness": 2, "safety": 2}')]
    out = {r.id: r for r in parse_judge(spark.createDataFrame(rows, "id int, judge_raw string")).collect()}
    for i in (1, 2, 3, 4):
        assert out[i].judge_ok and out[i].judge_avg == 4.25 and out[i].judge_reasoning == "ok"
    assert out[7].judge_ok and out[7].judge_avg == round(7 / 4, 2) and out[7].judge_reasoning == ""
    for i in (5, 6, 8):
        assert not out[i].judge_ok and out[i].judge_avg is None


def test_strict_mode_raises(spark):
    df = parse_judge(spark.createDataFrame([(1, "not json")], "id int, judge_raw string"))
    with pytest.raises(Exception):
        strict(df).collect()
