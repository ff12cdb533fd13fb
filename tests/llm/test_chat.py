from hashlib import sha256

from pyspark.sql import functions as F

from eventwatch.llm import chat, queries
from conftest_sql import oracle_rows

T = "conv_id long, turn long, role string, text string"


def formatted(spark, data):
    df = spark.createDataFrame(data, T).withColumn("parts", chat.text_part(F.col("text")))
    return chat.format_chat(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "learned", chat.read_loss(F.col("formatted"), F.col("loss")))


def test_control_strings_survive_and_do_not_control(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>x<|text|>y<|end|>\n", "\\<|end|>\\\\", "<\\|", "<|im_start|>", "[[INST]", "\\", "", None, "a\n\nb", "é😀<|"]
    data = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    r = formatted(spark, data).first()
    assert [(t.role, t.text) for t in r.turns] == [(a, b or "") for _, _, a, b in data]
    assert r.learned == "".join(t or "" for _, i, _, t in data if i % 2)
    assert r.formatted == chat.brute_force([(a, b) for _, _, a, b in data])
    assert r.formatted.count("<|end|>") == len(nasty) and "</s>" not in r.formatted and "[INST]" not in r.formatted


def test_order_ties_nulls_and_repeats(spark):
    data = [(2, 1, "b", "y"), (2, 1, "a", "z"), (2, 0, None, None), (2, 1, "a", "z"), (None, 0, "user", "q"), (3, 0, "ro\nle<|", "t")]
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in formatted(spark, data).collect()}
    assert got == {2: [("", ""), ("a", "z"), ("a", "z"), ("b", "y")], None: [("user", "q")], 3: [("ro\nle<|", "t")]}
    assert formatted(spark, []).count() == 0


def test_typed_parts(spark):
    parts = [("text", "see <|image|> ", None, None), ("image", None, "s3/i.png", 576), ("text", " and ", None, None), ("audio", "x", "a.wav", None),
             (None, "tail", None, None), ("document", None, None, 12)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, None)]), (1, 2, "user", None)],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_chat(df).first()
    assert "see <\\|image|> <|image|> and <|audio|>tail<|document|>" in r.formatted
    assert [(a.place, a.kind, a.ref, a.n_tokens) for a in r.attachments] == [
        (0, "image", "s3/i.png", 576), (1, "audio", "a.wav", 1), (2, "document", None, 12)]
    assert r.n_placeholder_tokens == 589 and r.n_turns == 3
    assert [r.formatted[x.start:x.start + x.length] for x in r.loss] == ["ok"]


def test_long_text(spark):
    text = "<|x" * 200_000
    r = formatted(spark, [(1, 0, "assistant", text)]).first()
    assert sha256(r.learned.encode()).hexdigest() == sha256(text.encode()).hexdigest()


def test_query_equals_sql(spark):
    got, want = oracle_rows(spark, "op2_chat")
    assert got == want and len(got) > 10


def test_native_plan(spark):
    plan = queries.op2_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
