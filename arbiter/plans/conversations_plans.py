"""Conversation queries: pairing, history, resets, session totals, status."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbiter.functions.judge import judge_prompt
from arbiter.operators import conversations as CV
from arbiter.operators import scoring as SC
from arbiter.plans.catalog import finalize, query
from arbiter.plans.oracle_views import TOK, register_view, with_views
from arbiter.sources import fixtures as FX

DEFAULT_SYSTEM = "You are a helpful assistant."   # used when a conversation has no system turn
EXACT_MEAN_LAT = ("(CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / "
                  "CAST(10 * count(latency_ms) AS DOUBLE))")

register_view("turns", (), f"""
    SELECT conv_id, turn, role, text, {TOK.format('text')} AS tokens,
           CAST((conv_id * 7919 + turn * 104729) % 90010 AS DOUBLE) / 10.0 AS latency_ms,
           (role = 'user' AND length(text) % 7 = 0) AS is_reset, conv_id AS parent_run_id
    FROM conversations""")
register_view("pairs_t", ("turns",), """
    SELECT conv_id, turn, prev_text AS user_message, text AS assistant_response, latency_ms,
           prev_tokens AS input_tokens, tokens AS output_tokens
    FROM (SELECT *, lag(role) OVER w AS prev_role, lag(text) OVER w AS prev_text,
                 lag(tokens) OVER w AS prev_tokens
          FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) t
    WHERE role = 'assistant' AND prev_role = 'user'""")
register_view("segs", ("turns",), """
    SELECT *, CAST(sum(CAST(is_reset AS BIGINT)) OVER (PARTITION BY conv_id ORDER BY turn
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment FROM turns""")
register_view("hist", ("segs",), """
    SELECT conv_id, turn, segment, text,
           coalesce(len(history), 0) AS n_history,
           coalesce(array_to_string(list_transform(history, lambda m: m.role), ','), '') AS roles,
           coalesce(len(list_filter(history, lambda m: m.role = 'user')), 0) AS n_user_messages,
           coalesce(list_sum(list_transform(history, lambda m: length(m.content))), 0) AS history_chars
    FROM (SELECT *, list(struct_pack(role := role, content := text)) OVER (
                   PARTITION BY conv_id, segment ORDER BY turn
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history
          FROM segs WHERE role IN ('user', 'assistant') AND NOT is_reset) h
    WHERE role = 'user'""")
_FS = FX.FEW_SHOTS
FEW_SHOT_CHARS = sum(len(c) for _, c in _FS)
FEW_SHOT_ROLES = ",".join(r for r, _ in _FS)
FEW_SHOT_USERS = sum(r == "user" for r, _ in _FS)
CHUNK = 4   # of messages; small, so that most conversations have several
register_view("assembled", ("hist",), f"""
    SELECT h.conv_id, h.turn, CAST(1 + {len(_FS)} + h.n_history + 1 AS BIGINT) AS n_messages,
           concat_ws(',', 'system', '{FEW_SHOT_ROLES}', nullif(h.roles, ''), 'user') AS roles,
           CAST({FEW_SHOT_USERS} + h.n_user_messages + 1 AS BIGINT) AS n_user_messages,
           CAST(length(coalesce(s.text, '{DEFAULT_SYSTEM}')) + {FEW_SHOT_CHARS} + h.history_chars
                + length(h.text) AS BIGINT) AS content_chars
    FROM hist h LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations
                              WHERE role = 'system' GROUP BY conv_id) s
      ON s.conv_id = h.conv_id""")


def turns(spark, sf_dir):
    return FX.turns(spark, sf_dir)


def pairs(spark, sf_dir):
    return CV.turn_pairs(turns(spark, sf_dir))


def messages(spark, sf_dir):
    return CV.numbered_messages(turns(spark, sf_dir), chunk=CHUNK)


def assembled(spark, sf_dir):
    """Every request whole: [system] + few shots + history + [user]."""
    t = turns(spark, sf_dir)
    # the system turn that opens the conversation; a second one must not double the rows
    sys = t.where(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("_sys"))
    h = CV.history_fold(t).join(sys, "conv_id", "left")
    return CV.message_assembly(h, F.coalesce(F.col("_sys"), F.lit(DEFAULT_SYSTEM)), FX.few_shots_col())


def _msg_stats(arr):
    """Number, roles, user messages and characters of an array of messages."""
    return (F.size(arr).cast("bigint"),
            F.array_join(F.transform(arr, lambda m: m["role"]), ","),
            F.size(F.filter(arr, lambda m: m["role"] == "user")).cast("bigint"),
            F.aggregate(arr, F.lit(0).cast("bigint"),
                        lambda a, m: a + F.coalesce(F.length(m["content"]).cast("bigint"), F.lit(0))))


@query("turn_pair_asof", with_views("""
    SELECT conv_id, turn, user_message, assistant_response FROM pairs_t""", "pairs_t"))
def q_turn_pair_asof(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", "user_message", "assistant_response")


@query("judge_prompt", with_views("""
    SELECT conv_id, turn, 'USER MESSAGE:' || chr(10) || user_message || chr(10) || chr(10)
           || 'ASSISTANT RESPONSE:' || chr(10) || assistant_response AS judge_prompt FROM pairs_t""",
    "pairs_t"))
def q_judge_prompt(spark, sf_dir):
    p = pairs(spark, sf_dir)
    return p.select("conv_id", "turn",
                    judge_prompt("user_message", "assistant_response").alias("judge_prompt"))


@query("step_index", with_views("""
    SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS step
    FROM conversations WHERE role = 'assistant'"""))
def q_step_index(spark, sf_dir):
    return CV.step_index(turns(spark, sf_dir))


@query("reset_segments", with_views("SELECT conv_id, turn, is_reset, segment FROM segs", "segs"))
def q_reset_segments(spark, sf_dir):
    return CV.reset_segments(turns(spark, sf_dir)).select("conv_id", "turn", "is_reset", "segment")


@query("history_fold", with_views(f"""
    SELECT conv_id, turn, segment, CAST(n_history AS BIGINT) AS n_history, roles,
           CAST(history_chars AS BIGINT) AS history_chars, CAST(n_user_messages AS BIGINT) AS n_user_messages, CAST(n_history // {CHUNK} AS BIGINT) AS chunk,
           CAST(n_history % {CHUNK} AS BIGINT) AS chunk_offset FROM hist""", "hist"))
def q_history_fold(spark, sf_dir):
    h = CV.history_fold(turns(spark, sf_dir))
    n, roles, users, chars = _msg_stats(F.col("history"))
    return h.select("conv_id", "turn", "segment", n.alias("n_history"), roles.alias("roles"), chars.alias("history_chars"),
                    users.alias("n_user_messages")).select(
        "*", F.expr(f"n_history div {CHUNK}L").alias("chunk"), (F.col("n_history") % CHUNK).alias("chunk_offset"))


@query("history_chunks", with_views(f"""
    SELECT conv_id, segment, CAST(place // {CHUNK} AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n_messages,
           string_agg(role, ',' ORDER BY place) AS roles, md5(string_agg(text, '' ORDER BY place)) AS content_md5
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, segment ORDER BY turn) - 1 AS place
          FROM segs WHERE role IN ('user', 'assistant') AND NOT is_reset) m
    GROUP BY conv_id, segment, place // {CHUNK}""", "segs"))
def q_history_chunks(spark, sf_dir):
    c = CV.history_chunks(messages(spark, sf_dir))
    each = lambda field: F.transform("messages", lambda m: m[field])
    return c.select("conv_id", "segment", "chunk", F.size("messages").cast("bigint").alias("n_messages"),
                    F.array_join(each("role"), ",").alias("roles"), F.md5(F.array_join(each("content"), "")).alias("content_md5"))


@query("message_assembly", with_views("SELECT conv_id, turn, n_messages, roles, content_chars, n_user_messages FROM assembled",
                                      "assembled"))
def q_message_assembly(spark, sf_dir):
    n, roles, users, chars = _msg_stats(F.col("messages"))
    return assembled(spark, sf_dir).select("conv_id", "turn", n.alias("n_messages"), roles.alias("roles"),
                                           chars.alias("content_chars"), users.alias("n_user_messages"))


@query("session_totals", with_views(f"""
    SELECT s.conv_id, CAST(coalesce(a.n_turns, 0) AS BIGINT) AS n_turns,
           CAST(coalesce(a.input_tokens, 0) AS BIGINT) AS input_tokens,
           CAST(coalesce(a.output_tokens, 0) AS BIGINT) AS output_tokens,
           CAST(coalesce(a.input_tokens, 0) + coalesce(a.output_tokens, 0) AS BIGINT) AS total_tokens,
           round_even(coalesce(a.avg_latency_ms, 0.0), 6) AS avg_latency_ms
    FROM (SELECT DISTINCT conv_id FROM conversations) s
    LEFT JOIN (SELECT conv_id, count(*) AS n_turns, sum(input_tokens) AS input_tokens,
                      sum(output_tokens) AS output_tokens, {EXACT_MEAN_LAT} AS avg_latency_ms
               FROM pairs_t GROUP BY conv_id) a ON a.conv_id = s.conv_id""", "pairs_t"))
def q_session_totals(spark, sf_dir):
    return finalize(CV.session_totals(turns(spark, sf_dir)))


@query("ordered_concat", """
    SELECT conv_id, CAST(length(doc) AS BIGINT) AS doc_chars, md5(doc) AS doc_md5
    FROM (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS doc FROM conversations GROUP BY conv_id) d""")
def q_ordered_concat(spark, sf_dir):
    t = turns(spark, sf_dir)
    d = CV.ordered_concat(t, "conv_id", "turn", "text", chunk=3)
    return d.select("conv_id", F.length("document").cast("bigint").alias("doc_chars"),
                    F.md5("document").alias("doc_md5"))


@query("conversation_status", """
    SELECT conv_id, arg_max(role, turn) AS last_role, CAST(count(*) AS BIGINT) AS n_turns,
           CAST(count_if(role = 'assistant') AS BIGINT) AS n_steps,
           CASE WHEN arg_max(role, turn) = 'assistant' THEN 'finished'
                WHEN arg_max(role, turn) = 'function_call' THEN 'pending_tool'
                WHEN count_if(role = 'assistant') >= 10 THEN 'stopped'
                ELSE 'awaiting_reply' END AS status
    FROM conversations GROUP BY conv_id""")
def q_conversation_status(spark, sf_dir):
    return CV.conversation_status(turns(spark, sf_dir))


@query("parent_child_runs", with_views("""
    SELECT parent_run_id, CAST(count(*) AS BIGINT) AS n_children, CAST(sum(tokens) AS BIGINT) AS total_tokens,
           round_even(max(latency_ms), 6) AS max_latency_ms, min(turn) AS first_turn
    FROM turns GROUP BY parent_run_id""", "turns"))
def q_parent_child_runs(spark, sf_dir):
    return finalize(CV.parent_rollup(turns(spark, sf_dir)))


@query("batch_generate", with_views("""
    SELECT a.conv_id, a.turn, a.n_messages, r.text AS reply, r.text IS NULL AS missing_response,
           CAST(r.latency_ms AS DOUBLE) AS latency_ms
    FROM assembled a LEFT JOIN (SELECT conv_id, turn - 1 AS turn, text, latency_ms FROM turns
                                WHERE role = 'assistant') r
      ON r.conv_id = a.conv_id AND r.turn = a.turn""", "assembled", "turns"))
def q_batch_generate(spark, sf_dir):
    # default responder = replay of the recorded assistant turn that follows
    req = assembled(spark, sf_dir).select("conv_id", "turn", F.size("messages").cast("bigint").alias("n_messages"))
    rec = turns(spark, sf_dir).where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"), "latency_ms")
    out = SC.replay(req, rec, ["conv_id", "turn"])
    return finalize(out.select("conv_id", "turn", "n_messages", "reply", "missing_response",
                               "latency_ms"))
