import random
import re

from touchline.llm.decontaminate import contained, drop_contaminated


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, items):
    out = {}
    for d, text, *_ in docs:
        for i, item in items:
            want = shingles(item)
            n = len(want & shingles(text))
            if want and n >= 0.8 * len(want) - 1e-9:
                out[d, i] = max(n, out.get((d, i), 0))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklmnopqrst") + rng.choice("xyz")
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 5, 6, 12, 30, 61])))) for i in range(40)] + [(90, None), (91, ""), (92, " ?! ")]
    docs = []
    for d in range(200):
        words = [word() for _ in range(rng.choice([0, 3, 60, 400]))]
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if part:
                    part[rng.randrange(len(part))] = rng.choice([word(), "É."])
            at = rng.randint(0, len(words))
            words[at:at] = [p.upper() + "," for p in part]
        docs.append((d, " ".join(words), d))
    docs += [(500, None, 0), (None, items[3][1], 0), (7, items[5][1], 0), (7, items[5][1], 0)] + [(600 + k, items[k][1], 0) for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_shared for r in contained(frame, bench).collect()}
    expected = brute(docs, items)
    assert got == expected and len(expected) > 60
    bad = {d for d, _ in expected}
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d[0] for d in docs if d[0] not in bad)
    assert contained(frame.limit(0), bench).count() == 0
    assert contained(frame, bench.limit(0)).count() == 0
    assert drop_contaminated(frame, bench.limit(0)).count() == len(docs)
