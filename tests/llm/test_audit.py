import itertools
import random
import re

import pytest

from touchline.llm import audit as A

SCHEMA = "doc_id long, text string, lang string, part string, mask int"


def brute(docs, labels):
    text_of = [(i, t or "", lang if lang is not None else "") for i, t, lang, *_ in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, t, part in text_of:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ""
        fails += "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t))
        fails += "D" * bool(re.search(r"[#$%&*|]", t))
        fails += "E" * (i is not None and any(j is not None and j < i and u == t for j, u, _ in text_of))
        rows.append((part, fails, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        table, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for k, c in enumerate(order):
                gone = [bool(set(order[:k]) & set(r[1])) for r in mine]
                here = [r for r, g in zip(mine, gone) if c in r[1] and not g]
                shapley[c] += len(here)
                table.append((
                    part, "".join(order), k + 1, sum(not g and c not in r[1] for r, g in zip(mine, gone)), len(here),
                    sum(g and c in r[1] for r, g in zip(mine, gone)), sum(r[1] == c for r in mine), sum(r[2] for r in here), sum(r[3] for r in here), c,
                ))
        out += [(*r[:-1], shapley[r[-1]]) for r in table]
    return sorted(out)


def made(rng, n):
    word = lambda: rng.choice(["w", "Wide", "é", "x#", "the", "END"]) + str(rng.randint(0, rng.choice([5, 3000])))
    docs = [(None, "same", None, "p", 9), (None, "same", "en", "p", 9), (1, None, "en", "p", 9), (2, "", "en", "p", 9), (3, " \t\n", None, "p", 9), (0, "same", "de", "p", 9), (7, "same", "", "p", 9)]
    for i in range(10, 10 + n):
        text = "".join(word() + rng.choice([" ", "\n", "\r\x0b "]) for _ in range(rng.choice([3, 199, 200, 420])))
        docs.append((i, text, rng.choice(["en", "en", "de", None]), "p", 9))
        for _ in range(rng.choice([0, 0, 0, 1, 30])):
            docs.append((rng.randint(-50, 5000), text, rng.choice(["en", "fr"]), "p", 9))
    docs += [docs[9]] * 3
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, *_ in docs if rng.random() < 0.5] + [(None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("size", [2 << 20, 100])
def test_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(A, "SLICE", size)
    docs, labels = made(random.Random(8), 60)
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in A.audit(frame, marks).collect())
    want = brute(docs, labels)
    assert got == want
    assert len(got) == 600 * 4


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs, labels).count() == 0
    one = A.audit(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string"), labels)
    assert one.count() == 600 and one.where("filter_order = 'ABCDE' and step = 1").first().removed == 1


def test_texts_with_one_hash_are_compared(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(A.F, "xxhash64", lambda *cols: F.lit(5).cast("long"))
    docs = spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "b", "p"), (4, "c", "p"), (5, "a", "p"), (5, "a", "p")], "doc_id long, text string, part string")
    assert sorted(r.doc_id for r in A.copies(docs).collect()) == [3, 5, 5]
