"""Benchmark decontamination against brute force, block and round splits."""

import hashlib
import random
import re

import pytest

from arbiter.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
VOCAB = "a b c über zwei Ärger x1 don".split()


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    """doc index -> (n_words, hit word places, item ids)"""
    out = []
    for _, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for item, itext in items:
            v = words_of(itext)
            n = min(window, len(v))
            if not n:
                continue
            wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
        out.append((len(w), hit, sorted(found)))
    return out


def corpus(seed, n_docs, n_items, long_item=0):
    rng = random.Random(seed)
    say = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(VOCAB) for _ in range(n))
    items = [(i, say(rng.randint(1, 9))) for i in range(n_items)]
    items += [(n_items, None), (n_items + 1, "!!"), (None, "null id item zwei"), (3, "a second text under an id")]
    if long_item:
        items.append((900, say(long_item)))
    docs = [(i, say(rng.randint(0, 60))) for i in range(n_docs)]
    for i in range(0, n_docs, 3):
        _, text = items[rng.randrange(n_items)]
        docs[i] = (i, docs[i][1] + ". " + text.upper() + "! " + say(4))
    if long_item:
        part = words_of(items[-1][1])[long_item // 2:long_item // 2 + 30]
        docs.append((7000, "xx " + " ".join(part) + " yy"))
    docs += [(1, docs[0][1]), (None, docs[0][1]), (5000, None), (5001, ""), (5002, " .. "), (5003, "null id item zwei")]
    return docs, items


@pytest.mark.parametrize("window,limits", [
    (4, {}), (2, {}), (1, {}), (10, {}),
    (4, {"block_bytes": 60}), (4, {"block_bytes": 60, "broadcast_bytes": 120})])
def test_brute_force(spark, window, limits):
    docs, items = corpus(window, 40, 25, long_item=200 if limits else 0)
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, contamination string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.match_benchmark(d, b, window, **limits).select("doc_id", "text", "contamination.*").collect()
    want = {}
    for (doc, text), (n, hit, found) in zip(docs, brute(docs, items, window)):
        want.setdefault((doc, text), []).append((n, hit, found))
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = want[r.doc_id, r.text][0]
        assert (r.n_words, r.n_hit, r["items"]) == (n, len(hit), found), r
        assert {j for s in r.spans for j in range(s.begin, s.end)} == hit
        assert all(x.end < y.begin for x, y in zip(r.spans, r.spans[1:]))


def test_automaton_is_exact_on_few_words():
    rng = random.Random(5)
    for case in range(300):
        items = [(str(i), " ".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode()) for i in range(4)]
        window = rng.randint(1, 6)
        sam = dc.SuffixAutomaton(items, window)
        text = " ".join(rng.choice("abz") for _ in range(60))
        _, hits, found, _ = sam.scan(text.encode())
        [(_, want, listed)] = brute([(0, text)], [(i, t.decode()) for i, t in items], window)
        assert {j for a, b in hits for j in range(a, b)} == want, case
        assert sorted(found) == listed, case


def test_long_text_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(dc, "CHUNK", 64)
    docs, items = corpus(9, 30, 20)
    sam = dc.SuffixAutomaton([(str(i), (t or "").encode()) for i, t in items], 5)
    for (_, text), (n, hit, _) in zip(docs, brute(docs, items, 5)):
        got = sam.scan((text or "").encode())
        assert (got[0], {j for a, b in got[1] for j in range(a, b)}) == (n, hit)


def test_removal_limits(spark):
    item = "one two three four five six"
    docs = [(1, "Keep this. One, two three four five six! And this too, please, all of it."), (2, "one two three four five six"),
            (3, "clean text"), (4, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([("i", item)], "item_id string, text string")
    got = {r.doc_id: r for r in dc.decontaminate(d, b, window=6, min_span=6, max_coverage=0.5).collect()}
    assert got[1].text == "Keep this.  ! And this too, please, all of it."
    assert got[2].text == "" and got[3].text == "clean text" and got[4].text is None
    kept = {r.doc_id: r.text for r in dc.decontaminate(d, b, window=6, min_span=7, max_coverage=1).collect()}
    assert kept[1] == docs[0][1] and kept[2] == docs[1][1]
    assert got[1].contamination.longest == 6


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert dc.match_benchmark(d, b).first().contamination.n_hit == 0
    assert dc.match_benchmark(d.limit(0), b).count() == 0


def test_query_digest(spark, tmp_path):
    from arbiter.llm.queries import QUERIES
    docs, items = corpus(3, 20, 10)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted((str(d), n, len(hit), len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), bool(hit))
                  for (d, _), (n, hit, f) in zip(docs, brute(docs, items, 10)))
    got = QUERIES["op11_decontamination"](spark, str(tmp_path))
    assert sorted((str(r[0]), *r[1:]) for r in got.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == want
