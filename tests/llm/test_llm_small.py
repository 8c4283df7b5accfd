"""Every operator and stage on small tables with nulls, empty and long texts,
ties, repeated rows, no rows and extra columns; results against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from arbiter.llm import (components, embedding_dedup, exchange, language_id, license_scan, merkle, mixing, packing,
                         simhash, substring_dedup, suffix_dedup, url_filter)
from arbiter.llm.queries import URL_RULES, bpe_50k

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "size long, score double, fp long, source_size long, start long")
VOCAB = {"en": "the of and that with river stone walking under light seven quiet garden".split(),
         "de": "der und nicht über straße wald häuser ging langsam dunkel sieben wieder".split(),
         "es": "el niño que por ayer camino piedra lentamente jardín siete canción río".split()}


def words(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang]) for _ in range(n))


def make_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lang = rng.choice(list(VOCAB))
        rows.append([i, words(rng, lang, rng.randint(1, 160)), lang if i % 7 else None, rng.choice(["a", "b", "c", None])])
    passage = words(rng, "en", 70)
    for i in (5, 17, 40):
        rows[i][1] = rows[i][1] + " " + passage + "\n" + words(rng, "en", 12)
    rows += [[60, None, "en", "a"], [61, "", None, None], [62, " \t\n ", "de", "b"], [63, "12345 !!! 678", "es", "c"],
             [64, rows[8][1], "en", "a"], [64, rows[8][1], "en", "a"], [64, "one two three", "en", "a"],
             [65, rows[17][1], "de", None], [66, words(rng, "de", 30_000), "de", "a"], [67, "x" * 5000, "en", "b"],
             [68, passage, "en", "c"], [69, "one", "en", "d"], [70, rows[17][1] + " extra", "en", "a"],
             [71, "Licensed under the GNU  General\nPublic License, version 3 or later. MIT License", "en", "d"]]
    return [(*r, len(r[1]) if r[1] is not None else None, 9, 0.5, 1, 2, 3) for r in rows]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def tokens(text):
    return (text or "").encode().split()


# ---------------------------------------------------------------- packing

def test_packing_places_every_id_once(docs, rows):
    files = bpe_50k()
    got = packing.pack_documents(docs, **files, window=64, rows_per_shard=40, with_ids=True).collect()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(files["tokenizer"])
    want = Counter()
    for r in rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for a in range(0, len(ids), 64):
            part = np.array(ids[a:a + 64], "<u4").tobytes()
            want[r[0], a, len(part) // 4, zlib.crc32(part), len(ids), part] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in got) == want
    fill = defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in got) / (64 * len(fill)) > 0.9


def test_packing_special_token_and_both_encoders():
    files = bpe_50k()
    fast, full = packing.Encoder(**files), packing.Encoder(files["tokenizer"])
    for text in ("a <|endoftext|> b", "", "  x\n\n y  ", "naïve — 文字 🙂 don't 12 345", "\x00\u200b"):
        assert fast.ids(text).tolist() == full.ids(text).tolist()


@pytest.mark.parametrize("space", [" ", "\n"])
def test_packing_very_long_white_space(space):
    files = bpe_50k()
    fast, full = packing.Encoder(**files), packing.Encoder(files["tokenizer"])
    text = "a" + space * 1_200_000 + "b"
    assert fast.ids(text).tolist() == full.ids(text).tolist()


def test_capacity_tree_is_best_fit():
    rng, tree, plain = random.Random(3), packing.CapacityTree(64), Counter()
    for no in range(2000):
        if rng.random() < .5:
            room = rng.randint(1, 63)
            tree.add(room, no)
            plain[room] += 1
        else:
            need = rng.randint(1, 63)
            fit = min((r for r, n in plain.items() if n and r >= need), default=None)
            got = tree.take(need)
            assert (got[0] if got else None) == fit
            if fit:
                plain[fit] -= 1


def test_sequences_join_ids(docs):
    packed = packing.pack_documents(docs.where("doc_id < 20"), **bpe_50k(), window=64, with_ids=True)
    packed = packed.cache()
    got = {r.sequence_id: (r.tokens, len(r.ids)) for r in packing.sequences(packed).collect()}
    assert got and all(n * 4 == size <= 256 for n, size in got.values())
    packed.unpersist()


# ---------------------------------------------------------------- urls

def judge(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = (0, "allow", None)
    for verdict, rule in URL_RULES:
        rule_host, _, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            best = max(best, (len(rule), verdict, rule), key=lambda b: b[0])
    return host, path, best[2], best[1]


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "://COM/", "http://Example.COM/en/x?y#z", "https://www.example.com/en/",
            "https://a.www.example.com/en/q", "http://example.com", "http://example.com/en", "http://xexample.com/en/a",
            "ftp://x.net/es/a/b", "http://net/fr/", "http://x.net/frx/", "http://x.net/?q=/es/", "a://b://c.com/en/\nq",
            "http://example.com./en/", "http://ÉX.com/", "http://a..com/x", "http://x.net#/es/", "http://com:80/"]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)] + [(0, None, "h", "v")],
                               "page_id long, url string, host string, verdict string")
    got = url_filter.judge_urls(df, URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == judge(r.url), r.url
    assert url_filter.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_url_ties_block_and_partial_segments():
    trie = url_filter.UrlTrie([("allow", "a.b/x"), ("block", "a.b/x"), ("allow", "b/xy/z")])
    assert trie.match("a.b", "/xylophone")[0] == "block"
    assert trie.match("q.b", "/xy/zoo") == ("allow", "b/xy/z") and trie.match("q.b", "/xy") is None


# ---------------------------------------------------------------- licenses

def test_licenses(docs, rows, empty):
    got = {}
    for r in license_scan.scan_licenses(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for row in rows:
        ws = pattern.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1] or ""))
        places = [(i, label) for p, label in license_scan.BASE_PHRASES.items() for i in range(len(ws))
                  if ws[i:i + len(p.split())] == p.split()]
        want = (len(ws), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
                ",".join(sorted({label for _, label in places})))
        assert want in [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got[row[0]]]
        assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
                   for r in got[row[0]])
    assert got[71][0].labels == "gpl,gpl-3.0-or-later,mit" and got[71][0].n_base == 2
    assert got[60][0].labels == "" and license_scan.scan_licenses(empty).count() == 0


def test_license_rules_and_containment():
    assert len(license_scan.build_rules()) >= 200
    s = license_scan.Scanner()
    assert s.scan("Licensed under CC BY-NC 4.0.")[5] == "cc-by,cc-by-nc-4.0"
    assert s.scan("gnu lesser general public license v2.1")[5] == "lgpl-2.1"
    assert s.scan("cc  bye, cc by, CC-BY\ncc by")[1] == 3
    assert s.scan("the mitre license and summit licenses")[1:6] == (0, None, None, "", "")
    rng = random.Random(2)
    rules = [license_scan.Rule(f"r{i}", rng.randint(0, 2), "a", "a" * rng.randint(1, 4)) for i in range(6)]
    text = "aaab" * 5 + "aaaaaa"
    hits = sorted((r.priority, m.start() - m.end(), m.start(), m.end(), r.label)
                  for r in rules for m in re.finditer(r.pattern, text))
    kept = []
    for h in hits:
        if not any(k[2] <= h[2] and h[3] <= k[3] for k in kept):
            kept.append(h)
    assert license_scan.Scanner({}, rules).detections(text, {"a"}) == [(k[4], k[2], k[3]) for k in kept]


def sampled(rng, parsed):
    """A text that the parsed expression matches, white space and choices at random."""
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            kind, value = rng.choice([a for a in arg if str(a[0]) != "NEGATE"])
            if str(kind) == "LITERAL":
                out += chr(value)
            elif str(kind) == "RANGE":
                out += chr(rng.randint(*value))
            else:
                out += {"CATEGORY_SPACE": rng.choice(" \n\t"), "CATEGORY_DIGIT": "7", "CATEGORY_WORD": "x"}[str(value)]
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            out += "".join(sampled(rng, inner) for _ in range(rng.randint(low, min(int(high), low + 2))))
        elif op == "SUBPATTERN":
            out += sampled(rng, arg[-1])
        elif op == "BRANCH":
            out += sampled(rng, rng.choice(arg[1]))
        else:
            assert op in ("AT", "ASSERT", "ASSERT_NOT"), op
    return out


def test_license_prefilter_loses_no_detection():
    rng, s = random.Random(8), license_scan.Scanner()
    every = {k for r in license_scan.build_rules() for k in r.keyword.split()}
    texts = ["permission is hereby\ngranted, free of charge", "redistributions of\nsource code must retain",
             "redistribution of source code must retain", "all rights\nreserved", "creative\ncommons attribution 4.0",
             "open\nsoftware license", "mit licence", "the mit\nlicense", "isc licence",
             "permission to use copy modify and distribute this software", "released into the public\ndomain",
             "do what\nthe fxxx you want to public license", "common\ndevelopment and distribution licence 1.0"]
    for t in texts:
        assert s.scan(t)[7] == s.detections(t, every) != [], t
    for rule in license_scan.build_rules():
        for _ in range(5):
            t = f"x {sampled(rng, re._parser.parse(rule.pattern))} "
            assert re.search(rule.pattern, t), (rule, t)
            assert s.scan(t)[7] == s.detections(t, every) != [], (rule, t)


def test_license_identifiers():
    s = license_scan.Scanner()
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "Zlib", "Unlicense", "WTFPL", "CC0-1.0"):
        assert s.scan(f"// SPDX-License-Identifier: {name}\n")[5] == name.lower()
    assert s.scan("SPDX-License-Identifier: MIT-0")[5] == ""


# ---------------------------------------------------------------- mixing

def water_fill(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    left = total
    while left > 1e-9 and open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if target[s] + left * weight[s] / w >= 2 * sizes[s] - 1e-9}
        if not over:
            return target | {s: target[s] + left * weight[s] / w for s in open_}
        share = {s: left * weight[s] / w for s in open_}
        left = 0.0
        for s in list(open_):
            take = min(share[s], 2 * sizes[s] - target[s])
            target[s] += take
            left += share[s] - take
        open_ -= over
    return target


def test_mixing(docs, rows, empty):
    out = mixing.taken(mixing.mix(docs, slots_per_shard=50))
    got = out.collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(tokens(r[1]))
    want = water_fill(sizes)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(tokens(r[1]))) for r in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    again = mixing.taken(mixing.mix(docs.repartition(5), slots_per_shard=50)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.taken(mixing.mix(empty)).count() == 0


def test_mixing_all_empty_texts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.taken(mixing.mix(df)).collect()] == [(0, 0.0)] * 2


def test_mix_slots_shards_and_texts(docs):
    unique = docs.dropDuplicates(["doc_id"])
    unique = unique.withColumn("row_no", F.col("doc_id") + 1)
    mixed = mixing.mix(unique, block=16, slots_per_shard=100, row="row_no")
    slots = mixed["slots"].collect()
    by_source = defaultdict(list)
    for s in slots:
        by_source[s.source].append(s.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_source.values())
    assert len({s.shard for s in slots}) > 1
    per_doc = {r.doc_id: r.taken for r in mixing.taken(mixed).collect()}
    texts = Counter()
    original = {r.doc_id: r.text for r in unique.collect()}
    for r in mixing.mixed_documents(unique, mixed, "row_no").collect():
        texts[r.doc_id] += len(tokens(r.text))
        it = iter(tokens(original[r.doc_id]))
        assert all(w in it for w in tokens(r.text))  # a subsequence of its document
        assert r.n_chars == len(r.text)
    assert {k: v for k, v in per_doc.items() if v} == dict(texts)


def test_mixed_rows_keep_repeated_rows_apart(docs, rows):
    got = Counter(r.source for r in mixing.mixed(docs).collect() for _ in tokens(r.text))
    want = water_fill(Counter(s for r in rows for s in [r[3]] * len(tokens(r[1]))))
    assert all(abs(got[s] - want[s]) <= 0.5 for s in want)
    assert mixing.mixed(docs).columns == docs.columns


# ---------------------------------------------------------------- merkle

def test_merkle_edits(docs, rows, empty):
    got = merkle.edit_likeness(docs).collect()
    assert len(got) == len(rows) and merkle.edit_likeness(empty).count() == 0
    prints = defaultdict(set)
    for r in docs.select("text").collect():
        prints[r.text or ""]
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1] or "")
    ids = sorted(texts)
    of = {}
    for r in got:
        assert r.n_chars in {len(t) for t in texts[r.doc_id]}
        after = texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]] | texts[r.doc_id]
        edits = {}
        for t in texts[r.doc_id]:
            for n in after:
                h = len(t) // 2
                edits[hashlib.sha256((t[:len(t) - h] + n[:h]).encode()).hexdigest()] = t
        assert r.edited_sha256 in edits
        t = edits[r.edited_sha256]
        assert of.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (hashlib.sha256(t.encode()).hexdigest() == r.edited_sha256)
    assert len(set(of.values())) == len(of)


def test_merkle_next_document_over_many_buckets(spark):
    rng = random.Random(4)
    ids = rng.sample(range(-10**12, 10**12), 400)
    df = spark.createDataFrame([(i, f"t{i} " * 4) for i in ids], "doc_id long, text string").repartition(7)
    rows = merkle.with_next(merkle.fingerprints(df), df.select("doc_id")).collect()
    order = sorted(ids)
    assert {r.doc_id: r.next_text for r in rows} == {
        a: f"t{b} " * 4 for a, b in zip(order, order[1:] + order[:1])}


def test_merkle_single_row_and_locate(spark):
    one = spark.createDataFrame([(7, "abcd")], "doc_id long, text string")
    assert merkle.edit_likeness(one).first().edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    pairs = spark.createDataFrame([("a\nb\n\nc\nd", "a\nb\n\nc\nX"), ("a", "a"), (None, ""), ("a\n\nb", "a"), ("p", "q\n\nr")],
                                  "l string, r string")
    got = [(r.equal, [tuple(e) for e in r.edits]) for r in merkle.locate_edits(pairs, "l", "r").collect()]
    assert got == [(False, [(1, 1)]), (True, []), (True, []), (False, [(1, 0)]), (False, [(0, 0), (1, 0)])]


# ---------------------------------------------------------------- simhash

def brute_fingerprint(text):
    import xxhash
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [b" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def smallest_reachable(ids, edges):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_simhash(spark, docs, rows, empty):
    got = simhash.near_duplicates(docs).collect()
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{f:016x}") for i, f in fps)
    nodes = list(range(len(fps)))
    edges = [(a, b) for a, b in itertools.combinations(nodes, 2) if (fps[a][1] ^ fps[b][1]).bit_count() <= 2]
    group = smallest_reachable(nodes, edges)
    low = defaultdict(list)
    for n in nodes:
        low[group[n]].append(fps[n][0])
    want = Counter((fps[n][0], f"{fps[n][1]:016x}", min(low[group[n]])) for n in nodes)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    one = spark.createDataFrame([("the a b",)], "text string").select(F.xxhash64("text")).first()[0]
    assert simhash.fingerprint("The a B") == one and simhash.near_duplicates(empty).count() == 0


def test_simhash_keeps_one_of_each_group(docs, rows):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in groups})


def test_simhash_rows_without_id(spark):
    near = " ".join(f"w{i}" for i in range(3000))
    base = brute_fingerprint(near)
    close = next(t for t in (f"{near} end{i}" for i in range(1000)) if 0 < (base ^ brute_fingerprint(t)).bit_count() <= 2)
    texts = [(None, near), (None, close), (None, near), (None, "quite another text"), (None, "and one more of them"),
             (7, "here is some row with an id"), (None, "here is some row with an id"), (3, "shared id, first text"),
             (3, "second text of that id")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    fps = [brute_fingerprint(t) for _, t in texts]
    edges = [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    group = smallest_reachable(range(len(fps)), edges)
    low = {g: min((texts[n][0] for n in group if group[n] == g and texts[n][0] is not None), default=None)
           for g in group.values()}
    got = simhash.near_duplicates(df).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter(
        (texts[n][0], f"{fps[n]:016x}", low[group[n]]) for n in group)
    kept = simhash.keep_one(df).collect()
    assert len(kept) == len(set(group.values())) == 6
    assert Counter(r.doc_id for r in kept) == Counter([None, None, None, 7, 3, 3])


def test_simhash_crowded_blocks_lose_nothing(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 400:  # one crowded neighbourhood, and strangers
        f = rng.choice(sorted(fps))
        fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, rep long")
    edges = [(i, j) for i, j in itertools.combinations(range(len(signed)), 2)
             if ((signed[i] ^ signed[j]) & (1 << 64) - 1).bit_count() <= 2]
    want = smallest_reachable(range(len(signed)), edges)
    found = simhash.links(df, max_bits=2, blocks=4, cell_rows=16)
    assert found.count() < 40 * len(signed)
    got = {r.node: r.component for r in components.connected_components(found).collect()}
    assert {i: got.get(i, i) for i in want} == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 120)] + [(1000, j) for j in range(1001, 1060)] + [
        (rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)] + [(3000, 3000)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {k: v for k, v in smallest_reachable(ids, [e for e in edges if e[0] != e[1]]).items()}


# ---------------------------------------------------------------- embeddings

def test_embeddings(spark):
    rng = np.random.default_rng(6)
    rows, dim = [], 12
    centre = rng.normal(size=(8, dim))
    for i in range(300):
        v = centre[rng.integers(8)] + rng.normal(size=dim) * rng.choice([.02, .1, .4])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3)) if i % 11 else None, 1.0))
    rows[5] = (5, rows[4][1], rows[4][2], 1.0)
    rows += [(5, rows[4][1], rows[4][2], 1.0), (400, [2 * x for x in rows[4][1]], rows[4][2], 1.0), (401, None, 1, 1.0),
             (402, [0.0] * dim, 1, 1.0), (403, [float("nan")] + [1.0] * 11, 1, 1.0), (404, [None] + [1.0] * 11, 1, 1.0),
             (405, [float("inf")] + [1.0] * 11, 1, 1.0), (406, [], 1, 1.0), (407, rows[4][1] + [1.0], rows[4][2], 1.0),
             (408, [3e38] * dim, 1, 1.0), (409, [1e-40] * dim, 1, 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept double")
    got = embedding_dedup.near_duplicates(df, 0.98).collect()
    data = [(r[0], None if r[1] is None or None in r[1] or not len(r[1]) else np.float32(r[1]).astype(float), r[2]) for r in rows]
    usable = [v is not None and lab is not None and np.isfinite(v).all() and v.any() for _, v, lab in data]

    def linked(a, b):
        (_, x, la), (_, y, lb) = data[a], data[b]
        if not (usable[a] and usable[b]) or la != lb or len(x) != len(y):
            return False
        x, y = x / abs(x).max(), y / abs(y).max()
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98

    edges = [(a, b) for a, b in itertools.combinations(range(len(data)), 2) if linked(a, b)]
    group = smallest_reachable(range(len(data)), edges)
    low, degree = defaultdict(list), Counter(x for e in edges for x in e)
    for n in group:
        low[group[n]].append(data[n][0])
    want = Counter((data[n][0], degree[n], min(low[group[n]]), data[n][0] == min(low[group[n]])) for n in group)
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_blocks_and_probes_lose_no_link(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(5, 16))[rng.integers(5, size=300)] + rng.normal(size=(300, 16)) * .09,
                        rng.normal(size=(200, 16))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, 1, 0, 16, bytearray(v.astype("<f8").tobytes())) for i, v in enumerate(x)],
                               "rep long, copies long, label long, dim int, vec binary")
    index = embedding_dedup.ProductQuantiser.fit(x[::3], 12)
    found = embedding_dedup.link_blocks(df, index, 16, 0.98, block_rows=32).groupBy("rep").sum("links").collect()
    near = (x @ x.T >= 0.98).sum(1) - 1
    assert {r[0]: r[1] for r in found if r[1]} == {i: int(n) for i, n in enumerate(near) if n}


# ---------------------------------------------------------------- language

def test_language(docs, rows, empty, spark):
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    hits = [r.lang_pred == truth[r.doc_id] for r in got if r.doc_id < 60 and truth[r.doc_id]]
    assert np.mean(hits) > .85
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (60, 61, 62, 63))
    assert language_id.identify(empty).count() == 0
    bare = spark.createDataFrame([(1, "hello there", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language_id.identify(bare).collect()] == [("und", 0.0)]


def test_language_predictions_ignore_labels_of_the_held_out_fold(docs):
    base = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    spoiled = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(spoiled).collect()} == base


def test_keep_identified_without_labels(docs, rows):
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    want = [r[0] for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert sorted(r.doc_id for r in language_id.keep_identified(bare).collect()) == sorted(want)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null")
    assert got.where("lang = lang_pred").count() / got.count() > .95


def test_cnn_tables_equal_the_plain_network():
    rng = np.random.default_rng(0)
    net = language_id.train(["the river and the stone"] * 20 + ["der wald und die häuser"] * 20, ["en"] * 20 + ["de"] * 20,
                            window=32, steps=20)
    x = net.windows(rng.integers(0, 256, 200).astype(np.uint8))
    emb = net.embedding[x]
    plain = np.concatenate([sum(emb[:, k:k + net.window] @ f[k] for k in range(w)).max(1)
                            for w, f in net.filters.items()], 1)
    assert np.allclose(language_id.Predictor(net).pooled(x), plain, atol=1e-4)


# ---------------------------------------------------------------- repeated words and bytes

def brute_words(texts, size):
    ws = [tokens(t) for t in texts]
    count = Counter(tuple(w[i:i + size]) for w in ws for i in range(len(w) - size + 1))
    for w in ws:
        gone = np.zeros(len(w) + 1, int)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i] += 1
                gone[i + size] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        yield len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()


@pytest.mark.parametrize("size", [1, 4, 35])
def test_repeated_words(docs, rows, empty, size):
    got = substring_dedup.remove_repeats(docs, window=size, with_text=True).collect()
    want = Counter((r[0], *b) for r, b in zip(rows, brute_words([r[1] for r in rows], size)))
    assert Counter(tuple(r) for r in got) == want
    assert substring_dedup.remove_repeats(empty, window=size).count() == 0


def brute_bytes(items, length):
    seen = set()
    for doc, text in items:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(s)
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        yield doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length,buckets", [(100, 8), (9, 3), (1, 2)])
def test_repeated_bytes(spark, docs, empty, length, buckets):
    # equal ids go by a hash of the text
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).orderBy("doc_id", "h").collect()
    got = suffix_dedup.remove_repeats(docs, length, buckets).collect()
    want = Counter(brute_bytes([(r.doc_id, r.text) for r in order], length))
    assert Counter(tuple(r) for r in got) == want
    assert suffix_dedup.remove_repeats(empty, length, buckets).count() == 0


def test_cut_repeats_keeps_columns_and_text(docs, rows):
    out = suffix_dedup.cut_repeats(docs)
    assert out.schema.names == docs.schema.names
    kept = {(r.doc_id, r.text): r for r in out.collect()}
    passage = next(r[1] for r in rows if r[0] == 68)
    assert sum(passage in (t or "") for _, t in kept) == 1
    assert all(r.n_chars == len(r.text) and r["size"] == 9 for r in kept.values())


@pytest.mark.parametrize("length", [1, 2, 5, 9, 50, 100, 1000])
def test_difference_cover(length):
    v, residues = suffix_dedup.difference_cover(length)
    assert v <= max(1, length)
    for a, b in itertools.product(range(v), repeat=2):
        assert any((a + s) % v in residues and (b + s) % v in residues for s in range(v))


def test_group_handles_equal_order_with_other_ties():
    rng = np.random.default_rng(1)
    order, tie = rng.integers(0, 6, 500).astype(np.uint64), rng.integers(0, 4, 500).astype(np.uint64)
    at, first = exchange.group(order, tie)
    assert sorted(at.tolist()) == list(range(500))
    assert [(order[i], tie[i]) for i in at] == sorted(zip(order, tie))
    assert len(first) == len({(o, t) for o, t in zip(order, tie)})


def test_segments_carry_other_columns(docs, rows):
    out = exchange.segments(docs, ordered=True, carry=True, segment_bytes=300).collect()
    assert len(out) > 10
    got = sorted(((d, r.score, r.source) for s in out for d, r in zip(s.doc_ids, s.rest)), key=str)
    assert got == sorted(((r[0], .5, r[3]) for r in rows), key=str)


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, docs, rows, tmp_path):
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "suffix_array_dedup", "mixing", "packing"]
    now, held = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert out.columns == names
        out.write.parquet(str(tmp_path / name))
        now = held[name] = spark.read.parquet(str(tmp_path / name))
    clean = {r[0] for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])}
    assert {r.doc_id for r in held["language_id"].collect()} == clean
    assert held["language_id"].count() == sum(r[0] in clean for r in rows)
    got = simhash.near_duplicates(held["language_id"]).collect()
    assert sorted(r.doc_id for r in held["simhash_near_dedup"].collect()) == sorted({r.component_id for r in got})
    mixed = held["mixing"].collect()
    assert Counter(r.doc_id for r in mixed) and max(Counter(r.doc_id for r in mixed).values()) <= 4
    packed = held["packing"].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}


def test_pipeline_writes_token_ids(spark, docs, tmp_path):
    few = docs.where("doc_id < 20")
    out = corpus_pipeline.STAGES[-1][1](spark, few, str(tmp_path)).cache()
    pieces = out.collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in pieces)
    got = {r.sequence_id: bytes(r.ids) for r in packing.sequences(out).collect()}
    out.unpersist()
    from tokenizers import Tokenizer
    tok, texts = Tokenizer.from_file(bpe_50k()["tokenizer"]), {r.doc_id: r.text for r in few.collect()}
    for r in pieces:
        ids = np.frombuffer(got[r.sequence_id], "<u4")[r.offset:r.offset + r.length].tolist()
        assert ids == (tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0])[r.start:r.start + r.length]


def test_pipeline_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_schema_of_test_rows_has_clashing_names():
    assert {"size", "score", "fp", "start"} <= set(T._parse_datatype_string(DOCS).names)
