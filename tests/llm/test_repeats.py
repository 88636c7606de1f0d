import random
import re

import numpy as np
import pytest

from touchline.llm import blocks, repeats


def brute(docs, length=20):
    split = [(i if i is not None else blocks.NO_ID, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in docs]
    first = {}
    for i, w in split:
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, w in split:
        gone = {s + k for s in range(len(w) - length + 1) if first[tuple(w[s : s + length])] < (i, s) for k in range(length)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def made(rng, n):
    word = lambda: f"w{rng.randint(0, 400)}"
    passages = [[word() for _ in range(rng.choice([19, 20, 21, 60]))] for _ in range(12)]
    docs = [(0, None, 1), (1, "", 1), (2, "same " * 70, 1), (3, "same " * 19, 1), (None, " ".join(passages[3]), 1), (5, "é\t" * 45, 1)]
    for i in range(10, 10 + n):
        words = [word() for _ in range(rng.choice([0, 5, 40, 150]))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        docs.append((i, rng.choice([" ", "\n", "\r\n\t"]).join(words), 1))
        if rng.random() < 0.1:
            docs.append((i + 1000, docs[-1][1], 1))
    docs += [(11, docs[8][1], 1), (11, docs[8][1], 1)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("block", "subtree"), [(6 << 20, 1 << 20), (3000, 40)])
def test_equals_brute_force(spark, monkeypatch, block, subtree):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "SUBTREE", subtree)
    docs = made(random.Random(13), 200)
    frame = spark.createDataFrame(docs, "doc_id long, text string, kept int").repartition(3)
    got = sorted((r.doc_id if r.doc_id is not None else blocks.NO_ID, r.n_words, r.n_removed, r.kept) for r in repeats.drop_repeats(frame).collect())
    assert got == brute(docs)


def test_empty_table_and_short_documents(spark):
    assert repeats.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = repeats.drop_repeats(spark.createDataFrame([(2, "a b"), (1, "a b")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed, r.kept) for r in rows) == [(1, 0, "a b"), (2, 0, "a b")]


def test_prefixes_split_large_groups(monkeypatch):
    monkeypatch.setattr(repeats, "SUBTREE", 3)
    rng = np.random.default_rng(3)
    one = rng.integers(0, 4, 200).astype(np.uint64) << np.uint64(60) | rng.integers(0, 3, 200).astype(np.uint64)
    two, ids, starts = rng.integers(0, 2, 200).astype(np.uint64), rng.integers(0, 9, 200), rng.integers(0, 9, 200)
    split = repeats.later_leaves(one, two, ids, starts)
    monkeypatch.setattr(repeats, "SUBTREE", 1000)
    assert (split == repeats.later_leaves(one, two, ids, starts)).all() and split.any()
