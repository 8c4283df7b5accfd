"""Rule evaluator vs a plain-Python model written from the definitions."""

import pytest
from pyspark.sql import types as T

from arbiter import schemas as S
from arbiter.functions.rules import rule_columns


def py_rule_eval(response, topics, must_not, max_words, cta="anything else"):
    low = response.lower()
    hits = [t for t in topics if t.lower() in low]
    misses = [t for t in topics if t.lower() not in low]
    viol = [t for t in must_not if t.lower() in low]
    wc = len(response.split())
    has_cta = cta in low
    score = max(0.0, min(1.0, len(hits) / max(len(topics), 1) - len(viol) * 0.25 + (0.1 if has_cta else 0.0)))
    return dict(topic_hits=len(hits), topic_misses=misses, must_not_violated=viol, word_count=wc,
                within_word_limit=wc <= max_words, ends_with_cta=has_cta,
                passed=score >= 0.6 and not viol, score=round(score, 3))


CASES = [
    ("Billing and refunds. Anything else?", ["billing", "refund"], [], 10),
    ("nothing here", [], [], 5),                                   # empty topics -> 0 (+cta)
    ("the the the", ["the", "the"], [], 3),                        # repeated topic
    ("abc", ["a"], [""], 3),                                       # empty keyword always violates
    ("alpha beta gamma", ["alpha", "beta", "delta", "zeta", "gamma"], [], 2),  # 0.6 exactly
    ("x y anything else", ["x", "y"], [], 10),                     # cta pushes over 1 -> clamp
    ("bad worse worst", ["bad"], ["worse", "worst", "bad", "ba"], 9),  # clamp at 0
    ("integration tests", ["integrat"], [], 9),                    # substring, not token
    ("ÉCOLE Straße", ["école", "STRASSE", "straße"], [], 9),       # unicode case
    ("a b c\x1cd\x85e\tf", ["a"], [], 2),                # unicode whitespace split
    ("one two three", ["one", "two", "three", "four", "five", "six"], ["xyz"], 100),
]


@pytest.mark.parametrize("cta", ["anything else", "thre"])
def test_rule_eval_matches_python_model(spark, cta):
    rows = [(str(i), r, t, m, mw) for i, (r, t, m, mw) in enumerate(CASES)]
    schema = T.StructType([T.StructField("case_id", T.StringType()),
                           T.StructField("response", T.StringType()),
                           T.StructField("expected_topics", S.STRINGS),
                           T.StructField("must_not_contain", S.STRINGS),
                           T.StructField("max_words", T.IntegerType())])
    out = rule_columns(spark.createDataFrame(rows, schema), cta_phrase=cta).orderBy("case_id").collect()
    got = {r["case_id"]: r for r in out}
    for i, (r, t, m, mw) in enumerate(CASES):
        exp = py_rule_eval(r, t, m, mw, cta)
        g = got[str(i)]
        for k, v in exp.items():
            assert g[k] == v, (i, k, g[k], v)


def test_exact_boundary_score_passes(spark):
    rows = [("c", "alpha beta gamma", ["alpha", "beta", "gamma", "q", "z"], [], 9)]
    schema = "case_id string, response string, expected_topics array<string>, must_not_contain array<string>, max_words int"
    r = rule_columns(spark.createDataFrame(rows, schema)).first()
    assert r["score"] == 0.6 and r["passed"] is True


def test_lowered_text_is_a_shared_projection(spark):
    """lower(response) is computed once, not inside each lambda (plan check)."""
    rows = [("c", "Some Text", ["some"], ["x"], 9)]
    schema = "case_id string, response string, expected_topics array<string>, must_not_contain array<string>, max_words int"
    df = rule_columns(spark.createDataFrame(rows, schema))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(response") == 1, plan
