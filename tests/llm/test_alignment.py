"""Cross-tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arbiter.llm import alignment as al
from arbiter.llm.queries import piece_32k


def brute(docs):
    """Rows of the contract from a plain two-pointer walk."""
    import sentencepiece
    from tokenizers import Tokenizer
    files = piece_32k()
    full = Tokenizer.from_file(files["tokenizer"])
    full.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=files["model"])
    letters = {c: b for b, c in enumerate(al.ByteSide._byte_letters())}
    grouped, holders = [], Counter()
    for _, text in docs:
        groups = []
        if text:
            e = full.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(letters[c] for c in full.id_to_token(i))) for i in e.ids]
            b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                  else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
            raw = (" " + text).encode()
            if b"".join(t for _, t in a) == raw == b"".join(t for _, t in b):
                i = j = x = y = 0
                now = ([], [])
                while i < len(a) or j < len(b):
                    if x <= y:
                        now[0].append(a[i][0])
                        x += len(a[i][1])
                        i += 1
                    else:
                        now[1].append(b[j][0])
                        y += len(b[j][1])
                        j += 1
                    if x == y:
                        groups.append(now)
                        now = ([], [])
        links = Counter((p, q) for ga, gb in groups for p in ga for q in gb)
        holders.update(links.keys())
        grouped.append((groups, links))
    highest = defaultdict(int)
    for (p, _), n in holders.items():
        highest[p] = max(highest[p], n)
    rows = []
    for (doc, _), (groups, links) in zip(docs, grouped):
        said = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        rows.append((doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups),
                     sum(links.values()), sum(n for pq, n in links.items() if holders[pq] == highest[pq[0]]),
                     sum(n * holders[pq] for pq, n in links.items()),
                     hashlib.sha256(said.encode()).hexdigest() if groups else "", said))
    return rows


def corpus():
    rng = random.Random(2)
    bits = ["the", "garden", "Straße", "niño", " ", "  ", "\n\n", "\t", "東京タワー", "🙂🙃", "don't", "x" * 40, "=" * 33,
            "<|endoftext|>", "<s>", "</s>", "<0x41>", "naïve", "12345678", "Ω≈ç√", "é́", " ", "\x00", " " * 50]
    docs = [(i, "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 80)))) for i in range(60)]
    docs += [(3, docs[3][1]), (None, docs[4][1]), (100, None), (101, ""), (102, " "), (103, "a▁b"), (104, "a"),
             (105, docs[5][1] * 200), (106, " " * 3000), (107, "\n" * 777 + "=" * 999)]
    return docs


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                       "groups_sha256", "groups").collect()), key=str)


def test_brute_force(spark):
    docs = corpus()
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, seg long, pair long").repartition(3)
    got = result(al.align_documents(d, **piece_32k(), with_groups=True))
    assert got == sorted(brute(docs), key=str)


def test_long_texts_in_chunks(monkeypatch):
    monkeypatch.setattr(al, "CHUNK_CHARS", 64)
    side = al.PieceSide(piece_32k()["model"])
    for _, text in corpus():
        if text and "▁" not in text:
            assert side.ids(text).tolist() == side.model.encode(text)


@pytest.mark.parametrize("seed", range(6))
def test_pieces_cut_anywhere(seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 300, rng.integers(0, 200)))
    b = np.unique(rng.integers(0, 300, rng.integers(0, 200)))
    want = np.intersect1d(a, b)
    for work in (1, 2, 3, 7, 50, 10_000):
        x, y = al.common_ends(a, b, work)
        assert a[x].tolist() == want.tolist() == b[y].tolist()
        i, j = al.merge_path(a, b, work)
        assert (np.diff(i + j)[:-1] == work).all() and i[-1] == len(a) and j[-1] == len(b)
        merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
        for p, q in zip(i.tolist(), j.tolist()):
            assert sum(s == 0 for _, s in merged[:p + q]) == p


def test_small_batches_and_large_groups(spark, monkeypatch):
    docs = corpus()
    aligner = al.Aligner(al.ByteSide(*[piece_32k()[k] for k in ("tokenizer", "ranks", "pattern")]),
                         al.PieceSide(piece_32k()["model"]))
    pairs = [aligner.encode(t) for _, t in docs if t and aligner.encode(t)]
    plain = aligner.align(pairs)
    for name, value in (("FULL_GROUP", 2), ("FULL_GROUP", 10 ** 6), ("PAIRS_AT_ONCE", 17)):
        monkeypatch.setattr(al, name, value)
    again = aligner.align(pairs)
    assert all(np.array_equal(plain[k], again[k]) for k in plain)


def test_pair_counts_and_empty(spark):
    d = spark.createDataFrame([(1, "the garden"), (2, "the house"), (3, None)], "doc_id long, text string")
    shift = al.Aligner(al.ByteSide(piece_32k()["tokenizer"]), al.PieceSide(piece_32k()["model"])).shift
    counts = al.pair_counts(al.alignments(d, **piece_32k()), shift)
    assert counts.agg(F.max("n_docs")).first()[0] == 2
    assert counts.where("n_docs > highest").count() == 0
    assert al.align_documents(d.limit(0), **piece_32k()).count() == 0
    assert al.align_documents(d.where("text is null"), **piece_32k()).first().n_links == 0
