"""Judge reply parsing and judge prompt construction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter import schemas as S
from arbiter.functions.json_fns import is_json
from arbiter.functions.rounding import exact_round
from arbiter.functions.text import col, strip


def judge_body(raw) -> Column:
    """Strip a Markdown fence (text between the 1st and 2nd ``` marks) and a
    leading ``json`` language tag, then surrounding whitespace."""
    r = strip(col(raw))
    fenced = F.coalesce(F.get(F.split(r, "```"), 1), F.lit(""))
    body = F.when(F.startswith(r, F.lit("```")), fenced).otherwise(r)
    body = F.when(F.startswith(body, F.lit("json")), F.substring(body, 5, 1 << 30)).otherwise(body)
    return strip(body)


def parse_judge(df: DataFrame, raw: str = "judge_raw") -> DataFrame:
    """Add judge dims (DOUBLE), reasoning ('' when absent), avg_score (2 dec)
    and ``judge_ok``: false when there is no reply, the text is not one JSON
    document (text before or after it counts), or any dim is missing or
    non-numeric."""
    # lambdas bind the body and the parsed reply once: a plain expression would
    # be copied into every column and filter that uses it
    bodies = F.array(judge_body(raw))
    replies = F.transform(bodies, lambda b: F.from_json(F.when(is_json(b), b), S.JUDGE_SCORES))

    def complete(j: Column) -> Column:
        ok = j[D.JUDGE_DIMENSIONS[0]].isNotNull()
        for d in D.JUDGE_DIMENSIONS[1:]:
            ok = ok & j[d].isNotNull()
        return F.when(ok, j)

    parsed = df.select("*", F.get(F.transform(replies, complete), F.lit(0)).alias("_j"))
    parsed = parsed.select("*", *[F.col(f"_j.{d}").alias(f"_jd_{d}") for d in D.JUDGE_DIMENSIONS])
    dims = [F.col(f"_j.{d}") for d in D.JUDGE_DIMENSIONS]
    ok = F.col("_j").isNotNull()
    return parsed.select(
        *df.columns,
        *[d.alias(f"judge_{n}") for d, n in zip(dims, D.JUDGE_DIMENSIONS)],
        F.coalesce(F.col("_j.reasoning"), F.lit("")).alias("judge_reasoning"),
        F.when(ok, exact_round("((((`_jd_helpfulness` + `_jd_faithfulness`) + `_jd_conciseness`) + "
                               "`_jd_safety`) / CAST(4.0 AS DOUBLE))", D.JUDGE_AVG_DECIMALS))
        .alias("judge_avg"),
        ok.alias("judge_ok"),
    )


def strict(df: DataFrame) -> DataFrame:
    """Strict mode: a malformed judge reply fails the job (as json.loads would)."""
    return df.withColumn("judge_ok", F.when(F.col("judge_ok"), F.lit(True)).otherwise(
        F.raise_error(F.lit("malformed judge reply"))))


def judge_prompt(user_message, response) -> Column:
    return F.concat(F.lit("USER MESSAGE:\n"), col(user_message),
                    F.lit("\n\nASSISTANT RESPONSE:\n"), col(response))
