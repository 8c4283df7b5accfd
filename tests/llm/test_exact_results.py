"""Results that must hold on inputs made to mislead the operators."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arbiter.llm import embedding_dedup, language_id, merkle, packing, simhash, substring_dedup
from arbiter.llm.queries import bpe_50k


# ---------------------------------------------------------------- repeated words

def thue_morse(n, flip=False):
    word = [0]
    while len(word) < n:
        word += [1 - b for b in word]
    return "".join("ba"[b ^ flip] for b in word[:n])


def test_words_that_polynomial_hashes_confuse_are_told_apart(spark):
    same = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{same} {thue_morse(1024)}"), (2, f"{same} {thue_morse(1024, True)}"), (3, f"{same} x"), (4, f"{same} x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df, window=35).collect()}
    assert got == {1: 0, 2: 0, 3: 35, 4: 35}


def test_sketch_never_underestimates(spark, monkeypatch):
    # cells few enough that most windows collide: more is passed on, nothing is lost
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(substring_dedup, "CELL_BITS", 4)
    monkeypatch.setattr(substring_dedup.X, "LEAST_SHARDS", 1)
    windows = Counter(tuple(t.split()[i:i + 5]) for _, t in rows for i in range(56))
    want = {}
    for doc, t in rows:
        w = t.split()
        gone = {j for i in range(56) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        want[doc] = len(gone)
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df, window=5).collect()}
    assert got == want


# ---------------------------------------------------------------- embeddings

@pytest.mark.parametrize("label", ["double", "string", "int"])
def test_one_id_on_other_vectors_labels_as_they_are_and_null_ids(spark, label):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(4, 8))
    labels = {"double": [1.2, 1.7, 2.0, None], "string": ["a", "b", "1", None], "int": [1, 2, 3, None]}[label]
    rows = []
    for i in range(160):
        v = base[rng.integers(4)] + rng.normal(size=8) * rng.choice([0.02, 0.2])
        vec_id = [1, 2, None, int(rng.integers(3, 60))][rng.integers(4)]
        rows.append((vec_id, [float(x) for x in v], labels[rng.integers(4)]))
    rows += [rows[0]] * 3 + [(1, rows[5][1], rows[5][2]), (None, rows[6][1], rows[6][2])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {label}")
    unit = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    edges = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
             if rows[a][2] is not None and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= 0.98]
    group = list(range(len(rows)))
    for _ in rows:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    degree, ids = Counter(x for e in edges for x in e), defaultdict(list)
    for i, g in enumerate(group):
        ids[g].append(rows[i][0])
    low = {g: min((x for x in v if x is not None), default=None) for g, v in ids.items()}
    want = Counter((rows[i][0], degree[i], low[group[i]], rows[i][0] == low[group[i]]) for i in range(len(rows)))
    got = embedding_dedup.near_duplicates(df, 0.98)
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == want


# ---------------------------------------------------------------- language

def test_only_letters_are_letters():
    net = language_id.train(["the of and with"] * 8 + ["der und die ist"] * 8, ["en"] * 8 + ["de"] * 8, steps=30)
    p = language_id.Predictor(net)
    got = p.predict(["½ ²³", "Ⅷ", "12 - 3", "", None, "ª", "the and", "д"])
    assert [lang for lang, _ in got[:5]] == ["und"] * 5
    assert all(lang != "und" and 0 < score <= 1 for lang, score in got[5:])


def test_windows_of_many_texts_go_together():
    rng = random.Random(1)
    words = {"en": "the of and with river".split(), "de": "der und nicht wald".split()}
    say = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    net = language_id.train([say(k, 30) for k in words for _ in range(20)], [k for k in words for _ in range(20)], steps=60)
    p = language_id.Predictor(net)
    texts = [say(rng.choice(list(words)), rng.choice([1, 5, 400])) for _ in range(60)] + [None, "", "7"]
    alone = [p.predict([t])[0] for t in texts]
    for chunk in (1, 7, 64, 1000):
        together = p.predict(texts, chunk)
        assert [a for a, _ in together] == [a for a, _ in alone]
        assert all(abs(a - b) < 1e-6 for (_, a), (_, b) in zip(together, alone))
    # by hand: the mean of the windows' distributions, weighted by their letters
    text = texts[0]
    x = net.windows(language_id.encode(text))
    conv = np.concatenate([sum(net.embedding[x][:, k:k + net.window] @ f[k] for k in range(w)).max(1)
                           for w, f in net.filters.items()], 1)
    weight = ((x >= 0x61) & (x <= 0x7A) | (x >= 0x80)).sum(1) + 1e-6
    share = weight @ net.probabilities(conv) / weight.sum()
    assert alone[0][0] == net.languages[share.argmax()] and abs(alone[0][1] - share.max()) < 1e-5


def test_filter_rejects_long_texts_of_no_language_only(spark):
    rng = random.Random(4)
    words = {"en": "the of and with river".split(), "de": "der und nicht wald".split(), "es": "el niño que por".split()}
    say = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, say(k, 40), k) for i, k in enumerate(list(words) * 40)]
    rows += [(1000, "q", None), (1001, "12 ½", None), (1002, None, "en"), (1003, "x" * 400, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language_id.keep_identified(df).collect()}
    assert set(range(120)) | {1000} <= kept and not kept & {1001, 1002}
    strict = {r.doc_id for r in language_id.keep_identified(df, least_score=1.01).collect()}
    assert strict == {1000}      # too short to judge


# ---------------------------------------------------------------- fingerprints

def plain_nodes(text):
    import hashlib
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sections = [[sha(p) for p in re.split("\n", s)] for s in re.split("\n\n", text)]
    digests = [sha("".join(ps)) for ps in sections]
    leaves = [m for s in re.split(r"(?<=[.!?]) |\n", text) for m in re.findall(r"(?:[^ \t\n\x0b\f\r]+[ \t\n\x0b\f\r]*){1,2}", s)]
    return ({(0, sha("".join(digests)))} | {(1, d) for d in digests} | {(2, p) for ps in sections for p in ps}
            | {(3, leaf) for leaf in leaves})


def likeness(a, b):
    x, y = plain_nodes(a), plain_nodes(b)
    return 2 * len(x & y) / (len(x) + len(y))


def test_likeness_against_plain_trees(spark):
    rng = random.Random(6)
    say = lambda n: "".join(rng.choice(["one", "two ", "three. ", "four\n", "five! ", "\n\n", "six é ", " "]) for _ in range(n))
    texts = [say(rng.randint(0, 60)) for _ in range(30)] + [
        "One here. Two there.", "Two there. One here.", "One here. Two there. Two there.", "a single sentence that is edited", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    after = texts[1:] + texts[:1]
    for r in merkle.edit_likeness(df).collect():
        t, n = texts[r.doc_id], after[r.doc_id]
        h = len(t) // 2
        edited = t[:len(t) - h] + n[:h]
        assert abs(r.near_next - likeness(t, n)) < 1e-12 and abs(r.near_edited - likeness(t, edited)) < 1e-12
        assert (r.near_next == 1) == (t == n) and (r.near_edited == 1) == (t == edited)
    got = {r.doc_id: r for r in merkle.edit_likeness(df).collect()}
    assert 0 < got[30].near_next < 1          # sentences swapped
    assert 0 < got[31].near_next < 1
    assert got[33].near_edited > 0            # a sentence of its own, edited


def test_buckets_follow_the_rows(spark):
    ids = [*range(3000), 10 ** 17, -10 ** 17]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(None, "none")], "doc_id long, text string")
    cell, buckets = merkle.id_buckets(df.select("doc_id"), 64)
    sizes = [r["count"] for r in df.withColumn("cell", cell).join(buckets, "cell").groupBy("bucket").count().collect()]
    assert sum(sizes) == len(ids) + 1 and max(sizes) < 200
    got = {r.doc_id: r.next_text for r in merkle.with_next(merkle.fingerprints(df), df.select("doc_id")).collect()}
    order = [None, *sorted(ids)]
    assert got == {a: f"text {b}" if b is not None else "none" for a, b in zip(order, order[1:] + order[:1])}


# ---------------------------------------------------------------- copies and packing

def test_the_kept_row_does_not_depend_on_the_layout(spark):
    rows = [(1, "one text of some words", s, n) for s, n in [("d", 1), ("a", 2), ("c", None), (None, 1), ("a", 1), ("a", 1)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    kept = {tuple(map(str, r)) for parts in (1, 2, 3, 6) for r in simhash.keep_one(df.repartition(parts)).collect()}
    assert len(kept) == 1


def test_shards_follow_the_documents(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    out = packing.pack_documents(df, **bpe_50k(), rows_per_shard=10)
    shards = {r[0] for r in out.select(F.shiftright("sequence_id", 40)).distinct().collect()}
    assert len(shards) > int(spark.conf.get("spark.sql.shuffle.partitions"))
