"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from arbiter.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_counts(docs, noise=31, shortest=7):
    n = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= shortest:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form, None, n, len(others), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def rows_of(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def corpus(seed=3, docs=80):
    rng = random.Random(seed)
    base = ["aaabbbb", "garden", "gardener", "gardéner", "GARDENERS", "öffnung", "mississippi", "abababab", "zzzzzzz",
            "step×÷ÿÀstep", "walking", "wålking"]
    def noisy(w):
        i = rng.randrange(len(w))
        return rng.choice([w, w, w, w[:i] + w[i + 1:], w[:i] + rng.choice("abzé") + w[i:],
                           w[:i] + rng.choice("abzé") + w[i + 1:]])
    out = [(i, " ".join(noisy(rng.choice(base)) for _ in range(rng.randint(0, 90)))) for i in range(docs)]
    out += [(1, out[0][1]), (None, out[2][1]), (900, None), (901, ""), (902, "1234 -- ."), (903, "gardener9gardener_gardener" * 40)]
    return out


def test_brute_force(spark):
    docs = corpus()
    got = rows_of(spelling.group_spellings(spark.createDataFrame(
        [(*d, 1) for d in docs], "doc_id long, text string, word long")))
    assert got == brute(brute_counts(docs))


def test_few_letters_and_chains(spark):
    rng = random.Random(8)
    counts = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))): rng.choice([2, 3, 20, 25, 250, 3000, 40000])
              for _ in range(400)}
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    want = brute(counts)
    assert got == want
    assert any(v[0] and v[1] != v[0] for v in want.values())


def test_long_words(spark):
    rng = random.Random(4)
    counts = {}
    for m in (62, 63, 64, 65, 66, 200, 5000):
        w = "".join(rng.choice("acgt") for _ in range(m))
        for _ in range(6):
            i = rng.randrange(len(w))
            for v in (w, w[:i] + w[i + 1:], w[:i] + "c" + w[i:], w[:i] + "é" + w[i + 1:], w[:i] + "t" + w[i + 2:]):
                counts[v] = rng.choice([2, 3, 30, 400])
    counts["a" * 64] = counts["a" * 65] = counts["a" * 66] = 7
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute(counts)


def test_chunks_flush_and_empty(spark, monkeypatch):
    docs = corpus(5, 10)
    rx = re.compile("[A-Za-zÀ-ÿ]{7,}")
    whole = {i: spelling._runs(rx, (t or "").encode()) for i, (_, t) in enumerate(docs)}
    monkeypatch.setattr(spelling, "CHUNK", 16)
    assert whole == {i: spelling._runs(rx, (t or "").encode()) for i, (_, t) in enumerate(docs)}
    none = spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string")
    assert spelling.group_spellings(none).count() == 0
    assert spelling.group_spellings(none.limit(0)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_rotation_rows():
    rows = list(spelling.rotations("aab"))
    assert {spelling.unrotated(p, c) for p, c, k in rows if k != spelling.WHOLE} == {"aab"}
    assert [k for _, _, k in rows] == [spelling.FIRST, spelling.LATER, spelling.FIRST] + [spelling.WHOLE] * 4
    high, low = spelling.rotation_hashes("abcab")
    assert len(set(zip(high.tolist(), low.tolist()))) == len(high) == 11
    # a word without one code point has, whole, the prefix that the longer word skipped to
    skip = spelling.rotation_hashes("xabcab")
    assert (skip[0][0], skip[1][0]) in set(zip(high.tolist(), low.tolist()))
