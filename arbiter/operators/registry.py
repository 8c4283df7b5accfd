"""Model registry state as queries over an append-only event table.

Event kinds: register, set_alias, delete_alias, set_tag, delete_version,
delete_model.  Order is ``seq`` (never wall-clock time).  Every state query
is a partial aggregation (``max_by`` / ``max``) keyed by model plus alias,
version or tag key, so a model with a huge history costs one partial row per
map task instead of a single sorted window partition.

Semantics of deletes: a version counts as deleted when a delete_version
event for it follows its registration.  Writes aimed at a version after its
deletion are rejected (the alias keeps its earlier holder); a deletion after
a write removes that alias or tag.  A model delete deletes all its versions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.operators.windows import next_min, previous_value, running_sum


def register_version(events: DataFrame) -> DataFrame:
    """Version number of each register event: 1 + number of earlier
    registrations of the same model (skew-tolerant running count)."""
    reg = events.where(F.col("kind") == "register").select(
        "model", "seq", "run_id", F.lit(1).cast("bigint").alias("_one"))
    out = running_sum(reg, ["model"], "seq", "_one", "version_no", SEQ_RANGE)
    return out.select("model", "seq", "run_id",
                      F.col("version_no").cast("string").alias("version"))


# ``seq`` is unique in the log, so a range of this width holds no more events.
SEQ_RANGE = 1 << 20


@dataclass(frozen=True)
class RegistryState:
    """What a log says up to an event.

    versions: model, version, reg_seq, run_id, del_seq (first deletion, of the
    version or its model, after its registration; NULL: it exists);
    aliases: model, alias, version, set_seq; tags: model, version, tag_key,
    tag_value, set_seq.  Of both, what holds now."""
    versions: DataFrame
    aliases: DataFrame
    tags: DataFrame


def fold_log(events: DataFrame, state: RegistryState | None = None,
             keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> RegistryState:
    """The state after ``events`` (all later than ``state``, where one is
    given).  A state is a log that has been shortened: its live versions are
    registrations, its aliases and tags are writes, so folding it together
    with new events gives what a replay of everything would.  ``keep`` may
    write a table (and read it back) before the next one is built on it."""
    lives = version_lives(events, state.versions.where("del_seq is null") if state else None)
    if state:
        lives = lives.unionByName(state.versions.where("del_seq is not null"))
    lives = keep(lives, "versions")
    ends = lives.select("model", "version", "del_seq")
    writes = events.where(F.col("kind").isin("set_alias", "delete_alias")).select(
        "model", "alias", F.when(F.col("kind") == "set_alias", F.col("version")).alias("version"), "seq")
    if state:
        writes = writes.unionByName(state.aliases.select("model", "alias", "version", F.col("set_seq").alias("seq")))
    last = accepted(writes, ends).groupBy("model", "alias").agg(
        F.max_by(F.struct("version", "del_seq"), "seq").alias("w"), F.max("seq").alias("set_seq"))
    aliases = keep(last.where(F.col("w.version").isNotNull() & F.col("w.del_seq").isNull()).select(
        "model", "alias", "w.version", "set_seq"), "aliases")
    tags = events.where(F.col("kind") == "set_tag").select("model", "version", "tag_key", "tag_value", "seq")
    if state:
        tags = tags.unionByName(state.tags.withColumnRenamed("set_seq", "seq"))
    tags = keep(accepted(tags, ends).where("del_seq is null").groupBy("model", "version", "tag_key").agg(
        F.max_by("tag_value", "seq").alias("tag_value"), F.max("seq").alias("set_seq")), "tags")
    return RegistryState(lives, aliases, tags)


def version_lives(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """model, version, reg_seq, run_id, del_seq of every version registered in
    ``events``, and of those in ``known`` (same columns, still live).

    Smallest later deletion by skew-tolerant windows: deletes are never
    listed, however often one version or model is deleted."""
    ev = events.where(F.col("kind").isin("register", "delete_version", "delete_model")).select(
        "model", "version", "seq", "kind", "run_id")
    if known is not None:
        ev = ev.unionByName(known.select("model", "version", F.col("reg_seq").alias("seq"),
                                         F.lit("register").alias("kind"), "run_id"))
    ev = ev.select("*", F.when(F.col("kind") == "delete_version", F.col("seq")).alias("_v"),
                   F.when(F.col("kind") == "delete_model", F.col("seq")).alias("_m"))
    whole = next_min(ev, ["model"], "seq", "_m", "_next_m", SEQ_RANGE).where(F.col("kind") != "delete_model")
    each = next_min(whole, ["model", "version"], "seq", "_v", "_next_v", SEQ_RANGE)
    first = each.where(F.col("kind") == "register").groupBy("model", "version").agg(
        F.min_by(F.struct("seq", "run_id", F.least("_next_m", "_next_v").alias("d")), "seq").alias("r"))
    return first.select("model", "version", F.col("r.seq").alias("reg_seq"), "r.run_id", F.col("r.d").alias("del_seq"))


def accepted(writes: DataFrame, ends: DataFrame) -> DataFrame:
    """``writes`` that came before their version's deletion, with its
    ``del_seq``; a removal (NULL version) is always accepted."""
    j = writes.join(ends, ["model", "version"], "left")
    return j.where(F.col("del_seq").isNull() | (F.col("seq") < F.col("del_seq")))


def alias_state(events: DataFrame) -> DataFrame:
    """Current (model, alias) -> version, with the seq of the winning write."""
    return fold_log(events).aliases


def tag_state(events: DataFrame) -> DataFrame:
    """Current tag (model, version, key) -> value (upsert; last write wins)."""
    return fold_log(events).tags


def tag_maps(tags: DataFrame) -> DataFrame:
    """One map<string,string> of current tags per version."""
    return tags.groupBy("model", "version").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("tag_key", "tag_value"))))
        .alias("tags"))


def latest_version(versions: DataFrame) -> DataFrame:
    """Highest version number per model that still exists, as an integer; a
    model without one has no row.  ``versions``: of a state, or a log."""
    if "kind" in versions.columns:
        versions = version_lives(versions)
    return versions.where("del_seq is null").groupBy("model").agg(
        F.max(F.col("version").cast("bigint")).alias("latest_version"))


def highest_version(events: DataFrame) -> DataFrame:
    """Highest number ever given per model, deleted or not (for numbering)."""
    return events.where(F.col("kind") == "register").groupBy("model").agg(
        F.max(F.col("version").cast("bigint")).alias("highest_version"))


def previous_alias_version(events: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """For every accepted alias write: the version that held the alias just
    before it, 'none' when it was unset: never set, removed, or its holder
    (or the model) deleted since.  Skew-tolerant lag over (model, alias)."""
    ends = (version_lives(events) if versions is None else versions).select("model", "version", "del_seq")
    writes = events.where(F.col("kind").isin("set_alias", "delete_alias")).select(
        "model", "alias", F.when(F.col("kind") == "set_alias", F.col("version")).alias("version"), "seq", "kind")
    held = accepted(writes, ends).select("model", "alias", "seq", "kind", F.struct("version", "del_seq").alias("holder"))
    out = previous_value(held, ["model", "alias"], "seq", "holder", "prev", SEQ_RANGE)
    gone = F.col("prev.del_seq") < F.col("seq")
    return out.where(F.col("kind") == "set_alias").select(
        "model", "alias", "seq", F.col("holder.version").alias("version"),
        F.coalesce(F.when(F.coalesce(gone, F.lit(False)), F.lit(None)).otherwise(F.col("prev.version")),
                   F.lit("none")).alias("prev_version"))


def gate_on_tag(candidates: DataFrame, tags: DataFrame, tag: str, accepted: str,
                out: str, lower: bool = False) -> DataFrame:
    """candidates(model, version) left-joined with one tag; missing tag = blocked."""
    t = tags.where(F.col("tag_key") == tag).select("model", "version",
                                                   F.col("tag_value").alias(f"{out}_value"))
    j = candidates.join(t, ["model", "version"], "left")
    v = F.coalesce(F.col(f"{out}_value"), F.lit(""))
    if lower:
        v = F.lower(v)
    return j.withColumn(out, v == F.lit(accepted))


def staging_gate(candidates: DataFrame, tags: DataFrame) -> DataFrame:
    """Production allowed only when tag cd_staging == 'pass'."""
    return gate_on_tag(candidates, tags, D.STAGING_TAG, D.STAGING_PASS, "staging_ok")


def approval_gate(candidates: DataFrame, tags: DataFrame, task_tag: str,
                  approved_value: str = D.APPROVED_VALUE) -> DataFrame:
    """Approved iff the task-named tag exists and lower(value) == approved."""
    return gate_on_tag(candidates, tags, task_tag, approved_value.lower(), "approved", lower=True)


def resolve_versions(requests: DataFrame, aliases: DataFrame) -> DataFrame:
    """requests(model, override, alias, fallback_alias) -> version + resolved_via.

    explicit override -> alias -> fallback alias; unresolved rows keep a NULL
    version (the rejects) instead of raising.  Both alias lookups go through
    one join: each request is expanded to its (rank, alias) candidates, joined
    with the alias state once, and the best rank is kept per request."""
    cols = requests.columns
    cand = requests.select(*cols, F.explode(F.array(
        F.struct(F.lit(1).alias("rk"), F.col("alias").alias("a")),
        F.struct(F.lit(2).alias("rk"), F.col("fallback_alias").alias("a")))).alias("_c")
    ).select(*cols, "_c.rk", F.col("_c.a").alias("_a"))
    st = aliases.select("model", F.col("alias").alias("_a"), F.col("version").alias("_v"))
    j = cand.join(st, ["model", "_a"], "left")
    best = j.groupBy(*cols).agg(F.min_by(F.struct("_v", "_a"), F.when(
        F.col("_v").isNotNull(), F.col("rk"))).alias("_b"))
    ov = F.nullif(F.col("override"), F.lit(""))
    version = F.coalesce(ov, F.col("_b._v"))
    via = (F.when(ov.isNotNull(), F.concat(F.lit("explicit:"), ov))
           .when(F.col("_b._v").isNotNull(), F.col("_b._a")))
    return best.select(*cols, version.alias("version"), via.alias("resolved_via"))


def alias_row(aliases: DataFrame, names=("candidate", "champion", "production")) -> DataFrame:
    """One row per model with the current holder of each named alias
    (a pivot with fixed values: one aggregation, no self-joins)."""
    return aliases.groupBy("model").pivot("alias", list(names)).agg(F.first("version"))


def resolve_row(row: DataFrame, alias: str, fallback: str | None, override: str = "override") -> DataFrame:
    """Same resolution as ``resolve_versions`` where all ask for one alias (+
    fallback), on the pivoted alias row with an ``override`` column."""
    ov = F.nullif(F.col(override), F.lit(""))
    fb = F.col(fallback) if fallback else F.lit(None).cast("string")
    via = (F.when(ov.isNotNull(), F.concat(F.lit("explicit:"), ov))
           .when(F.col(alias).isNotNull(), F.lit(alias))
           .when(fb.isNotNull(), F.lit(fallback)))
    return row.select("*", F.coalesce(ov, F.col(alias), fb).alias("version"), via.alias("resolved_via"))
