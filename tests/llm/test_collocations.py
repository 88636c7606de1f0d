import collections
import random
import re

import numpy as np
import pytest

from touchline.llm import collocations as C


def words_of_pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(docs, least=10, share=50, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for w in words_of_pieces(text):
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = collections.defaultdict(list)
    longer = collections.Counter()
    for (lang, w), a in f.items():
        if len(w) == 3 and a >= least:
            for part in (w[:2], w[1:]):
                longer[lang, part] = max(longer[lang, part], a)
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least or (longer[lang, w] and 100 * longer[lang, w] >= share * a):
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, r, p.decode(), -a, left, right, n[lang], -s)
        for lang, rows in found.items()
        for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def made(rng, n):
    words = [f"w{i}" for i in range(25)] + ["É", "Ä-b", "x y", "😀"]
    docs = [(None, "en"), ("", "en"), (" \t ", None), ("...,", "en"), ("solo", "xx"), ("a b", ""), ("A b\r\nA b", None)]
    docs.append(("tick " * 700, "en"))
    docs.append((" ".join(rng.choice(words) for _ in range(4000)), "en"))
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " ! "]) for _ in range(rng.choice([1, 5, 40, 200])))
        docs += [(text, rng.choice(["en", "en", "de", None]))] * rng.choice([1, 1, 1, 7])
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("size", "bucket", "longest", "top"), [(2 << 20, 1 << 20, 256, 2000), (300, 300, 7, 40)])
def test_equals_brute_force(spark, monkeypatch, size, bucket, longest, top):
    monkeypatch.setattr(C, "SLICE", size)
    monkeypatch.setattr(C, "BLOCK", 4 * size)
    monkeypatch.setattr(C, "BUCKET", bucket)
    monkeypatch.setattr(C, "LONGEST", longest)
    docs = made(random.Random(5), 120)
    frame = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    got = sorted(tuple(r) for r in C.collocations(frame, top=top).collect())
    assert got == brute(docs, top=top)
    assert len({r[0] for r in got}) >= 3


def test_empty_table_and_clashing_names(spark):
    assert C.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    rows = [("one two", "en", "x", 1, "y")] * 12
    frame = spark.createDataFrame(rows, "text string, lang string, phrase string, n int, chunk string")
    assert [tuple(r) for r in C.collocations(frame).collect()] == [("en", 1, "one two", 12, 12, 12, 24, 1000000)]


def test_products_beyond_64_bits(spark):
    rows = [("en", "a b", 3_000_000_000), ("en", "a", 4_000_000_007), ("en", "b", 3_000_000_001), ("en", "", 10**11)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, f long")
    C_frequent, C.frequent_phrases = C.frequent_phrases, lambda docs, least: frame
    try:
        (row,) = C.collocations(None).collect()
    finally:
        C.frequent_phrases = C_frequent
    assert row.score == 10**6 * 3_000_000_000**2 // (4_000_000_007 * 3_000_000_001)


def test_chunks_of_equal_passages_are_equal():
    rng = random.Random(1)
    passage = " ".join(f"v{rng.randint(0, 500)}" for _ in range(300))
    texts = [passage.encode(), (" ".join(f"u{k}" for k in range(20)) + " " + passage).encode()]
    chunks = []
    for t in texts:
        _, chunk, _ = C.parse(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        chunks.append(set(chunk.to_pylist()))
    assert len(chunks[0] & chunks[1]) >= len(chunks[0]) - 2 > 5


@pytest.mark.parametrize("limit", [1, 10, 100])
def test_slices_lose_no_word(limit):
    rng = random.Random(2)
    for _ in range(50):
        text = "".join(rng.choice(["a", "bb", "c" * 30]) + rng.choice([" ", "\t ", ".", " "]) for _ in range(rng.randint(0, 80))).encode()
        data = np.frombuffer(text, np.uint8)
        total, grams = 0, collections.Counter()
        for part, on in C.slices(data, limit):
            _, chunk, goes = C.parse(part, np.array([0, len(part)]), on)
            for c, g in zip(chunk.to_pylist(), goes):
                pieces = [piece.split(" ") for piece in c.split("\n")]
                own = [len(w) for w in pieces[:-1]] + [len(pieces[-1]) - 2 * g]
                total += sum(own)
                grams.update(tuple(w[i : i + 3]) for w, o in zip(pieces, own) for i in range(o) if i + 3 <= len(w))
        want = collections.Counter(tuple(w[i : i + 3]) for w in words_of_pieces(text.decode()) for i in range(len(w) - 2))
        assert grams == want and total == sum(len(w) for w in words_of_pieces(text.decode()))
