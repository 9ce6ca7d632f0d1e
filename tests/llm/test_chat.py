import pytest
from pyspark.sql import functions as F

from ringwise.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def turns_of(conversations):
    lines = chat.raw_lines(conversations)
    return chat.parse(lines, chat.learn(lines))


def test_roles_are_recovered(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    turns = turns_of(conversations)
    truth = chat.agreement(turns, conversations)
    n, right = truth.agg(F.count("*"), F.sum((F.col("role") == F.col("true_role")).cast("int"))).first()
    assert right / n > 0.97


def test_held_out_conversations(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    seen, unseen = conversations.where("conv_id % 2 = 0"), conversations.where("conv_id % 2 = 1")
    turns = chat.parse(chat.raw_lines(unseen), chat.learn(chat.raw_lines(seen)))
    n, right = chat.agreement(turns, unseen).agg(F.count("*"), F.sum((F.col("role") == F.col("true_role")).cast("int"))).first()
    # a missed boundary costs the two turns on its sides
    assert right / n > 0.95


def test_streamed_decoding_is_exact(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    model = chat.learn(chat.raw_lines(conversations))
    lines = []
    for r in chat.raw_lines(conversations).orderBy("conv", "place").limit(1_500).collect():
        lines.append(r["line"])
    decoder, got = chat.Decoder(model), []
    seen = [chat.seen(line, lines[i - 1] if i else None)[0] for i, line in enumerate(lines)]
    for features in seen:
        got += decoder.step(features)
    settled = len(got)
    got += decoder.end()
    score, back = model.start + model.odds(seen[0]), []
    for features in seen[1:]:
        paths = score[:, None] + model.move
        back.append(paths.argmax(axis=0))
        score = paths.max(axis=0) + model.odds(features)
    want = [int(score.argmax())]
    for best in reversed(back):
        want.append(int(best[want[-1]]))
    assert got == want[::-1] and settled > len(lines) // 2


def test_pasted_transcript(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    model = chat.learn(chat.raw_lines(conversations))
    text = ["System: be kind.", "User: hello there", "how are you?", "Assistant: fine.", "", "User: good"]
    lines = spark.createDataFrame([("c", i, t) for i, t in enumerate(text)], "conv string, place int, line string")
    got = [(r["role"], r["body"]) for r in chat.parse(lines, model).orderBy("turn").collect()]
    assert got == [("system", "be kind."), ("user", "hello there\nhow are you?"), ("assistant", "fine."), ("user", "good")]
    assert chat.parse(lines, model).orderBy("turn").first()["rendered"] == "<|system|>\nbe kind.\n<|end|>\n"


@pytest.mark.parametrize("rows", [[], [(1, 0, None, None), (None, None, "user", "hi"), (1, 1, "user", ""), (1, 1, "user", ""), (2, 0, "robot", "x"), (3, 0, "user", "long " * 9_000)]])
def test_odd_rows(spark, rows):
    conversations = spark.createDataFrame(rows, SCHEMA).withColumn("line", F.lit("clash"))
    bodies = [r["body"] for r in turns_of(conversations).collect()]
    assert all(b.strip() for b in bodies) and len(bodies) == (3 if rows else 0)


def test_only_opening_lines_lose_their_markers(spark):
    answer = ["fine.", "Model: T-800", "Answer: 42", "a: int = 3", "## Context", "that is all"]
    text = [("User: hello there", "user", True), ("how are you?", "user", False), ("Assistant: " + answer[0], "assistant", True), *((x, "assistant", False) for x in answer[1:])]
    rows = [(c, i, t, r, o) for c in range(40) for i, (t, r, o) in enumerate(text)]
    lines = spark.createDataFrame(rows, "conv long, place int, line string, role string, opens boolean")
    turns = chat.parse(lines, chat.learn(lines)).where("conv = 7").orderBy("turn").collect()
    assert [(r["role"], r["body"]) for r in turns] == [("user", "hello there\nhow are you?"), ("assistant", "\n".join(answer))]
    assert turns[1]["n_lines"] == len(answer)


def test_a_marker_of_another_role_stays(spark):
    text = [("Context: my robot", "user", True), ("Assistant: fine.", "assistant", True)]
    rows = [(c, i, t, r, o) for c in range(40) for i, (t, r, o) in enumerate(text)]
    lines = spark.createDataFrame(rows, "conv long, place int, line string, role string, opens boolean")
    turns = chat.parse(lines, chat.learn(lines)).where("conv = 7").orderBy("turn").collect()
    assert [(r["role"], r["body"]) for r in turns] == [("user", "Context: my robot"), ("assistant", "fine.")]
