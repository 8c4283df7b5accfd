"""Registry state queries vs a dict-based replay of the same event log."""

import random

from arbiter import schemas as S
from arbiter.operators import registry as R


def replay(events):
    """Sequential model: writes to a deleted version are rejected; a delete
    after a write removes it; model delete clears everything."""
    versions, deleted = {}, set()       # (model, version) -> registered seq
    aliases, tags = {}, {}
    for e in sorted(events, key=lambda e: e["seq"]):
        m, v, kind = e["model"], e["version"], e["kind"]
        if kind == "register":
            versions[(m, v)] = e["seq"]
        elif kind == "delete_version":
            if (m, v) in versions and (m, v) not in deleted:
                deleted.add((m, v))
                aliases = {k: x for k, x in aliases.items() if not (k[0] == m and x == v)}
                tags = {k: x for k, x in tags.items() if not (k[0] == m and k[1] == v)}
        elif kind == "set_alias":
            if (m, v) not in deleted:
                aliases[(m, e["alias"])] = v
        elif kind == "delete_alias":
            aliases.pop((m, e["alias"]), None)
        elif kind == "set_tag":
            if (m, v) not in deleted:
                tags[(m, v, e["tag_key"])] = e["tag_value"]
        elif kind == "delete_model":
            deleted |= {k for k in versions if k[0] == m}
            aliases = {k: x for k, x in aliases.items() if k[0] != m}
            tags = {k: x for k, x in tags.items() if k[0] != m}
    return aliases, tags


def random_log(seed, n=400):
    rnd = random.Random(seed)
    ev, nreg = [], {}
    for seq in range(n):
        m = f"m{rnd.randint(0, 3)}"
        r = rnd.random()
        if r < 0.15 or nreg.get(m, 0) == 0:
            nreg[m] = nreg.get(m, 0) + 1
            ev.append(dict(model=m, seq=seq, kind="register", version=str(nreg[m]), alias=None,
                           tag_key=None, tag_value=None))
            continue
        v = str(rnd.randint(1, nreg[m]))
        if r < 0.45:
            ev.append(dict(model=m, seq=seq, kind="set_alias", version=v,
                           alias=rnd.choice(["candidate", "champion", "production"]), tag_key=None, tag_value=None))
        elif r < 0.55:
            ev.append(dict(model=m, seq=seq, kind="delete_alias", version=None,
                           alias=rnd.choice(["candidate", "champion"]), tag_key=None, tag_value=None))
        elif r < 0.85:
            ev.append(dict(model=m, seq=seq, kind="set_tag", version=v, alias=None,
                           tag_key=rnd.choice(["cd_staging", "cc_result"]), tag_value=rnd.choice(["pass", "fail", "x"])))
        elif r < 0.97:
            ev.append(dict(model=m, seq=seq, kind="delete_version", version=v, alias=None, tag_key=None, tag_value=None))
        else:
            ev.append(dict(model=m, seq=seq, kind="delete_model", version=None, alias=None, tag_key=None, tag_value=None))
    return ev


def to_df(spark, events):
    rows = [(e["model"], e["seq"], None, e["kind"], e["version"], e["alias"], e["tag_key"], e["tag_value"], None)
            for e in events]
    return spark.createDataFrame(rows, S.REGISTRY_EVENT)


def test_alias_and_tag_state_match_replay(spark):
    for seed in range(6):
        events = random_log(seed)
        df = to_df(spark, events)
        exp_alias, exp_tags = replay(events)
        got_alias = {(r.model, r.alias): r.version for r in R.alias_state(df).collect()}
        got_tags = {(r.model, r.version, r.tag_key): r.tag_value for r in R.tag_state(df).collect()}
        assert got_alias == exp_alias, seed
        assert got_tags == exp_tags, seed


def test_register_version_and_latest(spark):
    events = [e for e in random_log(11) if e["kind"] == "register"]
    df = to_df(spark, events).drop("version")
    got = {(r.model, r.seq): r.version for r in R.register_version(df).collect()}
    exp = {(e["model"], e["seq"]): e["version"] for e in events}
    assert got == exp
    latest = {r.model: r.latest_version for r in R.latest_version(to_df(spark, events)).collect()}
    assert latest == {m: max(int(e["version"]) for e in events if e["model"] == m) for m in latest}


def test_resolve_versions_fallback_and_rejects(spark):
    ev = [("m1", 1, "register", "1", None), ("m1", 2, "set_alias", "1", "production"),
          ("m2", 3, "register", "1", None), ("m2", 4, "set_alias", "1", "champion"),
          ("m3", 5, "register", "1", None)]
    df = spark.createDataFrame([(m, s, None, k, v, a, None, None, None) for m, s, k, v, a in ev], S.REGISTRY_EVENT)
    req = spark.createDataFrame([("m1", "", "champion", "production"), ("m2", "", "champion", "production"),
                                 ("m3", "", "champion", "production"), ("m3", "7", "champion", "production")],
                                "model string, override string, alias string, fallback_alias string")
    got = {(r.model, r.override): (r.version, r.resolved_via)
           for r in R.resolve_versions(req, R.alias_state(df)).collect()}
    assert got == {("m1", ""): ("1", "production"), ("m2", ""): ("1", "champion"), ("m3", ""): (None, None),
                   ("m3", "7"): ("7", "explicit:7")}


def test_tag_maps(spark):
    events = random_log(21)
    _, exp_tags = replay(events)
    got = {(r.model, r.version): dict(r.tags) for r in R.tag_maps(R.tag_state(to_df(spark, events))).collect()}
    exp = {}
    for (m, v, k), val in exp_tags.items():
        exp.setdefault((m, v), {})[k] = val
    assert got == exp


def test_snapshot_and_delta_equal_a_full_replay(spark):
    from pyspark.sql import functions as F
    from arbiter.sources import registry_snapshot as RS
    from arbiter.sources.sinks import fresh_path
    for seed in range(3):
        events = random_log(seed + 40, 500)
        df = to_df(spark, events)
        root = fresh_path(spark, "registry-test")
        for upto in (120, 121, 333, 333, 499):
            state = RS.refresh(spark, root, df.where(F.col("seq") <= upto))
            exp_alias, exp_tags = replay([e for e in events if e["seq"] <= upto])
            full = R.fold_log(df.where(F.col("seq") <= upto))
            assert {(r.model, r.alias): r.version for r in state.aliases.collect()} == exp_alias, (seed, upto)
            assert {(r.model, r.version, r.tag_key): r.tag_value for r in state.tags.collect()} == exp_tags, (seed, upto)
            for name in ("versions", "aliases", "tags"):
                a, b = getattr(state, name), getattr(full, name)
                assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), (name, upto)
        assert RS.newest(spark, root)[1] == 499


def test_registry_queries_scan_the_state_once(spark):
    from arbiter.plans.catalog import registry
    from conftest import SF_MID
    for name, most in (("alias_state", 1), ("tag_state", 1), ("staging_gate", 2), ("promotion_decision", 2)):
        df = registry()[name].build(spark, SF_MID)
        df.write.format("noop").mode("overwrite").save()
        p = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in p.splitlines() if "Scan parquet [model#" in line]
        assert 1 <= len(scans) <= most, (name, scans)
        assert "kind#" not in p and "seq#" not in p.replace("set_seq#", "").replace("reg_seq#", ""), name
