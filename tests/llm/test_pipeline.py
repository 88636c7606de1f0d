import random
from collections import Counter

import corpus_pipeline

COMMON = "the of and to in is was with for a".split()


def prose(rng, n=80):
    return " ".join(rng.choice(COMMON) if rng.random() < 0.4 else "".join(rng.choice("bcdfgaeiou") for _ in range(7)) for _ in range(n))


def test_each_stage_takes_effect_and_clean_documents_stay(spark, tmp_path):
    rng = random.Random(12)
    item = prose(rng, 30)
    clean = [(i, prose(rng)) for i in range(60)]
    docs = clean + [
        (100, " ".join(f"{w}$$$" for w in prose(rng).split())),
        (101, "too short"),
        (102, clean[5][1]),
        (103, clean[6][1] + " end"),
        (104, f"{prose(rng)} {item.upper()} {prose(rng)}"),
        (105, f"{prose(rng)} write to x.y@example.com now"),
        (106, None),
    ]
    rows = [(i, t, "en", "src", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {*range(60), 105}
    from touchline.llm.bpe import decode

    text = decode(corpus_pipeline.TOKENIZER, got[105].ids)
    assert "example" not in text and "email" in text
    assert all(r.n_tokens == len(r.ids) > 0 for r in got.values())


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(name for name, _ in corpus_pipeline.STAGES).most_common(1)[0][1] == 1
    for _, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0
