import hashlib

from pyspark.sql import functions as F

from touchline.llm.chat import format_chat, loss_text, read_chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted int"


def read(spark, rows):
    out = format_chat(spark.createDataFrame(rows, SCHEMA)).select("conv_id", "formatted", read_chat(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"), F.array_join(F.col("segments.text"), "").alias("joined"))
    return {r.conv_id: r for r in out.collect()}


def test_round_trip_of_texts_that_look_like_marks(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<", "|<|", "<!|<!!|<!", "", None, "a\nb\n", "\\$1 <|im_next|>", "<|line|>", "é\U0001f600" * 3000]
    rows = [(1, i, "assistant" if i % 3 else "user", t, 0) for i, t in enumerate(texts)]
    got = read(spark, rows)[1]
    assert [(t.role, t.text) for t in got.turns] == [(r[2], r[3] or "") for r in rows]
    assert got.loss == "".join(r[3] or "" for r in rows if r[2] == "assistant")
    assert got.joined == got.formatted


def test_merges_neighbours_of_one_role_and_orders_ties(spark):
    rows = [(1, 2, "user", "c", 0), (1, 1, "user", "b", 0), (1, 1, "user", "a", 0), (1, 3, "assistant", "x", 0), (1, 3, "assistant", "x", 0), (2, None, None, "y", 0), (2, 0, "a\nb", "z", 0), (None, 0, "assistant", "n", 0)]
    got = read(spark, rows)
    assert got[1].formatted == "<|im_start|>user\na<|im_next|>b<|im_next|>c<|im_end|>\n<|im_start|>assistant\nx<|im_next|>x<|im_end|>\n"
    assert [(t.role, t.text) for t in got[2].turns] == [("", "y"), ("a\nb", "z")]
    assert got[2].loss == "" and got[None].loss == "n"


def test_empty_table_and_query_digests(spark, tmp_path):
    assert format_chat(spark.createDataFrame([], SCHEMA)).count() == 0
    from touchline.llm.queries import op4_chat

    spark.createDataFrame([(7, 0, "user", "q", 0), (7, 1, "assistant", "a<|", 0)], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in op4_chat(spark, str(tmp_path)).collect()}
    assert got[7].turns_sha256 == hashlib.sha256(b"user\nq\nassistant\na<|\n").hexdigest()
    assert (got[7].n_turns, got[7].loss_chars, got[7].loss_sha256) == (2, 3, hashlib.sha256(b"a<|").hexdigest())
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len("<|im_end|><|im_start|>assistant ok")
