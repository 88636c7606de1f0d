import math
import random
import re
import zlib
from collections import Counter

from touchline.llm import blocks
from touchline.llm.lm import score


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(docs, prior):
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, *_ in docs}
    one, two, left = Counter(), Counter(), Counter()
    for i, t, *_ in docs:
        if not held[i]:
            w = tokens(t)
            one.update(w)
            two.update(zip(["<", *w], w, strict=False))
            left.update(["<", *w[:-1]])
    n, v = sum(one.values()), len(one)
    p = lambda x: (one[x] + 1) / (n + v + 1)
    out = []
    for i, t, *_ in docs:
        w = tokens(t)
        base = sum(math.log10(p(x)) for x in w)
        model = sum(math.log10((two[u, x] + prior * p(x)) / (left[u] + prior)) for u, x in zip(["<", *w], w, strict=False))
        out.append((-1 if i is None else i, held[i], len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(model, 6)))
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    rng = random.Random(14)
    docs = [(i, rng.choice([" ", "\n"]).join(rng.choice("aAbcdeÉ") + rng.choice("xyz") for _ in range(rng.randint(0, 60))), 1) for i in range(120)]
    docs += [(500, None, 1), (None, "ax by", 1), (7, docs[7][1], 1), (501, "only here", 1), (502, " \t", 1)]
    got = score(spark.createDataFrame(docs, "doc_id long, text string, score int").repartition(3), prior=5.0)
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.collect())
    assert rows == brute(docs, 5.0)
    assert score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


