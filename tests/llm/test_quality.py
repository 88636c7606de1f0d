import random

import pyarrow as pa
from pyspark.sql import functions as F

from touchline.llm import quality
from touchline.llm.quality import MEASURES, RULES, estimate, judge, measure


def brute(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(threes) if threes.count(t) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_measures_equal_brute_force():
    rng = random.Random(3)
    texts = [None, "", " ", "\n\n", "a", "a b a b a b a", "\x1c\x85 é\n é\né", "x\r\nx\n", "#* <|>\n#* <|>", "one\n"]
    texts += ["".join(rng.choice(["a ", "b ", "é ", "# ", "\n", "\t", "A! "]) for _ in range(rng.randint(0, 120))) for _ in range(300)]
    got = measure(pa.array(texts))
    assert list(zip(*(got[m].tolist() for m in MEASURES[:5]), strict=True)) == [brute(t) for t in texts]


def test_estimate_finds_the_accuracies_of_made_votes():
    rng = random.Random(4)
    accuracy, counts = [0.95, 0.9, 0.8, 0.7, 0.6], {}
    for _ in range(40_000):
        good = rng.random() < 0.7
        votes = tuple(0 if rng.random() < 0.2 else (1 if good else -1) * (1 if rng.random() < a else -1) for a in accuracy)
        counts[votes] = counts.get(votes, 0) + 1
    found = estimate(counts, 5)
    assert abs(found.good - 0.7) < 0.02
    assert all(abs(a - b) < 0.02 for a, b in zip(found.accuracy, accuracy, strict=True))


def test_judges_prose_and_junk(spark):
    rng = random.Random(5)
    plain, common = "river garden morning letter window summer island people market winter".split(), "the of and to in is was with for a".split()
    prose = " ".join(rng.choice(common if rng.random() < 0.4 else plain) for _ in range(200))
    rows = [(i, f"{prose} number {i}", "x") for i in range(40)]
    rows += [(100, " ".join(f"{w}$$$" for w in prose.split()), "x"), (101, " | ".join(w for w in prose.split() if len(w) > 4), "x")]
    rows += [(102, " ".join(f"{w}!!".upper() for w in prose.split()), "x"), (103, None, "x"), (104, "", "x"), (None, prose, "x"), (None, prose, "x")]
    got = judge(spark.createDataFrame(rows, "doc_id long, text string, kept string"))
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert all(by[i].kept for i in [*range(40), None])
    assert not any(by[i].kept for i in range(100, 105))
    assert by[103].base_failed and not by[100].base_failed
    assert len(by[0].votes) == len(RULES)
    assert judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_text_goes_to_the_tasks_once(spark):
    """It was sent beside the row that holds it, which doubled what a task holds (pipeline's memory)."""
    docs = spark.createDataFrame([(i, None if i == 3 else f"word {i} " * i) for i in range(9)], "doc_id long, text string")
    found = quality.measures(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and " AS text" not in plan
    assert {r["row"]["doc_id"]: r["n_words"] for r in found.collect()} == {i: 0 if i == 3 else 2 * i for i in range(9)}
    other = quality.measures(docs.withColumn("text", F.col("doc_id")))  # a column of another type is still cast
    assert {r["row"]["doc_id"]: r["n_words"] for r in other.collect()} == {i: 1 for i in range(9)}
