import random

from pyspark.sql import functions as F

from parcelion.llm import chat


def test_any_text_comes_back(spark):
    rng = random.Random(1)
    parts = ["\\", "</turn>", "###", "### user: ", " </turn>\n", "\n", ": ", "\\b", "\\c", "<", "#", "a", "é\U0001f600", " "]
    make = lambda: "".join(rng.choices(parts, k=rng.randrange(6)))
    rows = [(c, t, make() if c % 5 == 0 else rng.choice(["user", "assistant"]), make()) for c in range(80) for t in range(4)]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = out.withColumn("formatted", chat.formatted(F.col("pieces"))).withColumn("loss", chat.under_loss(F.col("pieces")))
    for r in out.withColumn("read", chat.parse(F.col("formatted"))).collect():
        own = sorted((t, role, text) for c, t, role, text in rows if c == r.conv_id)
        assert r.round_trip and [(x.role, x.text) for x in r.read] == [(role, text) for _, role, text in own]
        assert r.loss == "".join(text for _, role, text in own if role == "assistant")
        assert all("###" not in p.piece and "</turn>" not in p.piece for p in r.pieces if p.loss)


def test_plain_turns_are_not_escaped(spark):
    rows = [(1, 0, "user", "a < b # c"), (1, 1, "assistant", "yes: C:\\dir")]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    text = out.select(chat.formatted(F.col("pieces")).alias("t")).first().t
    assert text == "### user: a < b # c </turn>\n### assistant: yes: C:\\dir </turn>\n"


def test_main_path_is_native(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.format_chat(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
