import random

import numpy as np

from touchline.llm import near


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, size=2, percent=80):
    sets = {}
    for d, text, *_ in docs:
        w = words(text)
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def made(rng, n):
    vocabulary = [f"w{i}" for i in range(300)]
    docs = [(1, None, "x"), (2, "", "x"), (3, "One", "x"), (4, "one", "x"), (5, "É x", "x"), (6, "é X", "x")]
    base = [rng.choice(vocabulary) for _ in range(120)]
    for d in range(10, 10 + n):
        if rng.random() < 0.3:
            text = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 30, 90]))]
        elif rng.random() < 0.5:  # a large group around one base, with chains
            text = list(base)
            for _ in range(rng.choice([0, 0, 3, 6, 9])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
        else:
            text = words(rng.choice(docs[-20:])[1])
            for _ in range(rng.choice([0, 1, 2])):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(vocabulary).upper()
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(text), "x"))
    return docs


def test_equals_brute_force(spark):
    docs = made(random.Random(9), 350)
    frame = spark.createDataFrame(docs, "doc_id long, text string, kept string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(frame, size=2).collect()}
    assert got == brute(docs)


def test_blocks_of_large_clusters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 800)
    docs = made(random.Random(10), 150)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string, kept string"), size=2).collect()}
    assert got == brute(docs)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 2**63, 600).astype(np.uint64), rng.integers(0, 2**63, 400).astype(np.uint64)
    both = np.concatenate([common, own[:200], common, own[200:]])
    one, two = near.signatures(both, np.array([0, 800, 1600]))
    assert abs((one == two).mean() - 0.6) < 0.08


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    docs = [(3, "a b c d e f g", "x"), (1, "A b c d e f g", "y"), (2, "something else here now it is", "z"), (None, "a b c d e f g", "n"), (2, "something else here now it is", "z")]
    kept = near.drop_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string, kept string"))
    assert kept.columns == ["doc_id", "text", "kept"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "2", "None"]
    assert near.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
