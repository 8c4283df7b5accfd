"""Conversation folds over the turns table (conv_id, turn, role, text, ...).

Ordered per-conversation work uses windows partitioned by conversation.
Running counters (step index, reset segments, places in the history) use the
skew-tolerant bucketed running sum.  Histories are pointers into chunks of
messages; ``history_fold`` and ``expand_history`` build whole arrays, every
earlier message of every turn, for consumers that need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.rules import exact_mean
from arbiter.operators.windows import previous_value, running_sum, running_sums

MSG = "struct<role:string,content:string>"


def turn_links(turns: DataFrame) -> DataFrame:
    """Every turn with the role, tokens and number of the turn before it
    (bucketed skew-tolerant lag); texts do not travel.  A turn that was
    delivered more than once counts once (of different rows, the smallest)."""
    once = turns.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "tokens", "latency_ms")).alias("_one"))
    x = once.select("conv_id", "turn", "_one.*").select(
        "*", F.struct(F.col("role").alias("r"), F.col("tokens").alias("k"), F.col("turn").alias("t")).alias("_src"))
    return previous_value(x, ["conv_id"], "turn", "_src", "prev").drop("_src")


def is_pair() -> Column:
    """The turn is a reply to the user message right before it."""
    return (F.col("role") == "assistant") & F.coalesce(F.col("prev.r") == "user", F.lit(False))


def turn_pairs(turns: DataFrame) -> DataFrame:
    """Each assistant reply with the user message right before it; the two
    texts are fetched by (conv_id, turn) once the pairs are known."""
    pairs = turn_links(turns).where(is_pair()).select(
        "conv_id", "turn", F.col("prev.t").alias("user_turn"), "latency_ms",
        F.col("prev.k").alias("input_tokens"), F.col("tokens").alias("output_tokens"))
    # one text per turn, from the row that counts
    texts = turns.groupBy("conv_id", "turn").agg(
        F.min(F.struct("role", "tokens", "latency_ms", "text"))["text"].alias("text"))
    said = texts.select("conv_id", F.col("turn").alias("user_turn"), F.col("text").alias("user_message"))
    reply = texts.select("conv_id", "turn", F.col("text").alias("assistant_response"))
    return pairs.join(said, ["conv_id", "user_turn"]).join(reply, ["conv_id", "turn"]).select(
        "conv_id", "turn", "user_message", "assistant_response", "latency_ms", "input_tokens", "output_tokens")


def step_index(turns: DataFrame) -> DataFrame:
    """0-based step number of each assistant turn within its conversation."""
    a = turns.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.lit(1).cast("bigint").alias("_one"))
    out = running_sum(a, ["conv_id"], "turn", "_one", "_n")
    return out.select("conv_id", "turn", (F.col("_n") - 1).alias("step"))


def reset_segments(turns: DataFrame, is_reset: str = "is_reset") -> DataFrame:
    """Segment number = resets seen up to and including this turn; a reset
    clears history, later turns start the next segment."""
    x = turns.withColumn("_r", F.col(is_reset).cast("bigint"))
    out = running_sum(x, ["conv_id"], "turn", "_r", "segment")
    return out.drop("_r")


def history_fold(turns: DataFrame, is_reset: str | None = "is_reset") -> DataFrame:
    """For every user turn: the user/assistant messages before it in the same
    segment (system and reset commands are not history)."""
    seg = reset_segments(turns, is_reset) if is_reset else turns.withColumn("segment", F.lit(0))
    msgs = seg.where(F.col("role").isin("user", "assistant") &
                     (~F.col(is_reset) if is_reset else F.lit(True)))
    w = (Window.partitionBy("conv_id", "segment").orderBy("turn")
         .rowsBetween(Window.unboundedPreceding, -1))
    hist = F.collect_list(F.struct(F.col("role"), F.col("text").alias("content"))).over(w)
    return msgs.select("*", hist.alias("history")).where(F.col("role") == "user")


# --- histories that share their prefixes ---------------------------------------------
#
# The history of a user turn is a prefix of its segment's messages.  Messages
# are numbered and kept once, in chunks of bounded size; a turn keeps a pointer:
# how many messages come before it and in which chunk that place is.  Output
# is linear in the turns; whole arrays are built only for a consumer.

HISTORY_CHUNK = 1024


def numbered_messages(turns: DataFrame, is_reset: str = "is_reset", chunk: int = HISTORY_CHUNK) -> DataFrame:
    """The user and assistant messages with their place in the segment
    (``n_history``: messages before it), what came before in characters and
    user messages, and the chunk that the place is in.  Counted by ranges of
    the conversation (see ``windows``), so a long one is many tasks."""
    msgs = reset_segments(turns, is_reset).where(F.col("role").isin("user", "assistant") & ~F.col(is_reset))
    x = msgs.withColumn("_one", F.lit(1).cast("bigint")).withColumn(
        "_chars", F.coalesce(F.length("text").cast("bigint"), F.lit(0))).withColumn(
        "_user", (F.col("role") == "user").cast("bigint"))
    x = running_sums(x, ["conv_id", "segment"], "turn", {"_n": "_one", "_c": "_chars", "_u": "_user"})
    return x.withColumn("n_history", F.col("_n") - 1).select(
        *msgs.columns, "n_history", (F.col("_u") - F.col("_user")).alias("n_user_messages"),
        (F.col("_c") - F.col("_chars")).alias("history_chars"),
        F.expr(f"n_history div {int(chunk)}L").alias("chunk"), (F.col("n_history") % chunk).alias("chunk_offset"))


def history_pointers(messages: DataFrame) -> DataFrame:
    """One row per user turn: its history as a pointer into the chunks."""
    return messages.where(F.col("role") == "user")


def history_chunks(messages: DataFrame) -> DataFrame:
    """conv_id, segment, chunk, messages: at most a chunk's number in order."""
    listed = F.sort_array(F.collect_list(F.struct("n_history", "role", F.col("text").alias("content"))))
    return messages.groupBy("conv_id", "segment", "chunk").agg(
        F.transform(listed, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def expand_history(pointers: DataFrame, chunks: DataFrame) -> DataFrame:
    """``pointers`` with ``history``, the array of their earlier messages: for
    a consumer that needs it whole, as large as all prefixes together."""
    key = ["conv_id", "segment"]
    got = (pointers.select(*key, "turn", F.col("chunk").alias("_upto")).join(chunks, key)
           .where(F.col("chunk") <= F.col("_upto")).groupBy(*key, "turn")
           .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "messages"))),
                                      lambda c: c["messages"])).alias("_all")))
    return pointers.join(got, [*key, "turn"]).withColumn(
        "history", F.slice("_all", F.lit(1), F.col("n_history").cast("int"))).drop("_all")


def message_assembly(history: DataFrame, system: Column, few_shots: Column) -> DataFrame:
    """[system] + few_shots + history + [user] per user turn."""
    sys_msg = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
    user_msg = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    return history.withColumn("messages", F.concat(sys_msg, few_shots, F.col("history"), user_msg))


def session_totals(turns: DataFrame) -> DataFrame:
    """Per conversation: completed turns, input/output/total tokens, mean
    latency; zeros (mean latency 0.0) without a completed turn.  One pass: the
    links are aggregated, turns that end no pair count nothing."""
    x = turn_links(turns).select(
        "conv_id", F.when(is_pair(), F.col("prev.k")).alias("input_tokens"),
        F.when(is_pair(), F.col("tokens")).alias("output_tokens"),
        F.when(is_pair(), F.col("latency_ms")).alias("latency_ms"), is_pair().cast("bigint").alias("pair"))
    g = x.groupBy("conv_id").agg(
        F.sum("pair").alias("n_turns"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).cast("bigint").alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).cast("bigint").alias("output_tokens"),
        F.coalesce(exact_mean("latency_ms", 1), F.lit(0.0)).alias("avg_latency_ms"))
    return g.select("conv_id", "n_turns", "input_tokens", "output_tokens",
                    (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"), "avg_latency_ms")


def ordered_concat(parts: DataFrame, key: str, order: str, text: str,
                   chunk: int = 4096) -> DataFrame:
    """Texts of each key concatenated in ``order``.  Two levels: rows are
    first joined within chunks of ``chunk`` consecutive order values, then the
    chunk strings are joined in chunk order, so no single sort holds more than
    ``chunk`` rows of a group."""
    c = parts.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)).cast("bigint"))
    lvl1 = c.groupBy(key, "_chunk").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))),
        lambda s: s["t"]), "").alias("_piece"))
    return lvl1.groupBy(key).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("_chunk", "_piece"))), lambda s: s["_piece"]), "")
        .alias("document"))


def conversation_status(turns: DataFrame, max_iter: int = D.AGENT_MAX_ITER) -> DataFrame:
    """finished when the last message is the assistant's; pending_tool when it
    is a function call; stopped after max_iter assistant steps; otherwise
    awaiting_reply."""
    s = turns.groupBy("conv_id").agg(
        F.max_by("role", "turn").alias("last_role"),
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if(F.col("role") == "assistant").alias("n_steps"))
    status = (F.when(F.col("last_role") == "assistant", F.lit("finished"))
              .when(F.col("last_role") == "function_call", F.lit("pending_tool"))
              .when(F.col("n_steps") >= F.lit(max_iter), F.lit("stopped"))
              .otherwise(F.lit("awaiting_reply")))
    return s.select("conv_id", "last_role", F.col("n_turns").cast("bigint").alias("n_turns"),
                    F.col("n_steps").cast("bigint").alias("n_steps"), status.alias("status"))


def parent_rollup(children: DataFrame, parent: str = "parent_run_id") -> DataFrame:
    """Nested runs: child metrics rolled up to their parent run."""
    return children.groupBy(parent).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_children"),
        F.sum("tokens").cast("bigint").alias("total_tokens"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.min("turn").alias("first_turn"))
