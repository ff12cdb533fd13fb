"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an array of parts (type, text, ref, n_tokens). ``flatten_parts`` visits them in order: text is
escaped and copied; an image, audio or document becomes a placeholder that stands for ``n_tokens`` tokens; its reference
and token count are recorded as an attachment with its place among all attachments. ``format_chat`` puts the turns of a
conversation together under a template and marks the characters that training takes its loss on.

Escaping is reversible: a backslash is doubled, and a backslash goes behind the first character of whatever
could start a control string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``). So control strings in the output
are always the template's own, and ``unescape`` (drop each backslash, keep what follows it) gives the text back.

Defined cases: null roles and texts are empty; null or unknown part types count as text; null token counts are 1;
equal turn numbers are ordered by role, then content; null conversation ids form one conversation; an empty table gives
an empty result. A conversation's output is one string, so its turns meet in one task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.llm.common import quoted

TURN, SEP, END = "<|turn|>", "<|text|>", "<|end|>"
MEDIA = ("image", "audio", "document")
PART = "struct<type:string,text:string,ref:string,n_tokens:int>"
LEARNED_ROLE = "assistant"

_CONTROL = r"(<)(?=\||/?s>)|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), _CONTROL, "$1$2\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """One text as a turn's content."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("n_tokens"))).cast(f"array<{PART}>")


def _visit(part: Column) -> Column:
    """What a part looks like in the output."""
    look = escape(part["text"])
    for kind in MEDIA:
        look = F.when(part["type"] == kind, F.lit(f"<|{kind}|>")).otherwise(look)
    return look


def flatten_parts(parts: Column) -> Column:
    """Content parts -> struct: content (escaped text and placeholders, in order), attachments (kind, ref, n_tokens),
    n_placeholder_tokens (what the placeholders expand to)."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    media = F.filter(parts, lambda p: F.coalesce(p["type"].isin(*MEDIA), F.lit(False)))
    listed = F.transform(media, lambda p: F.struct(p["type"].alias("kind"), p["ref"].alias("ref"),
                                                   F.coalesce(p["n_tokens"], F.lit(1)).alias("n_tokens")))
    return F.struct(F.array_join(F.transform(parts, _visit), "").alias("content"), listed.alias("attachments"),
                    F.aggregate(listed, F.lit(0).cast("bigint"), lambda s, a: s + a["n_tokens"]).alias("n_placeholder_tokens"))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
                learned: str = LEARNED_ROLE) -> DataFrame:
    """One row a conversation: its id, formatted, loss (start and length of each learned text, in code points from 0),
    attachments (place, kind, ref, n_tokens), n_placeholder_tokens, n_turns."""
    flat = flatten_parts(F.col(quoted(parts)))
    rows = turns.select(F.col(quoted(conv)).alias("conv"), F.struct(
        F.col(quoted(turn)).alias("turn"), escape(F.col(quoted(role))).alias("role"), flat.alias("flat")).alias("t"))
    rows = rows.select("conv", F.struct(F.col("t.turn").alias("turn"), F.col("t.role").alias("role"), F.col("t.flat.content").alias("content"),
                                        F.col("t.flat.attachments").alias("attachments"), F.col("t.flat.n_placeholder_tokens").alias("n")).alias("t"))
    got = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    head = lambda t: F.concat(F.lit(TURN), t["role"], F.lit(SEP))
    whole = lambda t: F.concat(head(t), t["content"], F.lit(END + "\n"))
    sizes = F.transform("ts", lambda t: F.struct(F.length(head(t)).alias("head"), F.length(t["content"]).alias("text"),
                                                 (t["role"] == learned).alias("learned")))
    got = got.withColumn("sizes", sizes)
    tail = len(END) + 1
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(s: Column, x: Column) -> Column:
        span = F.array(F.struct((s["at"] + x["head"]).alias("start"), x["text"].cast("bigint").alias("length")))
        return F.struct((s["at"] + x["head"] + x["text"] + tail).alias("at"), F.when(x["learned"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    listed = F.flatten(F.transform("ts", lambda t: t["attachments"]))
    return got.select(
        F.col("conv").alias(conv), F.array_join(F.transform("ts", whole), "").alias("formatted"), F.aggregate("sizes", start, step)["spans"].alias("loss"),
        F.transform(listed, lambda a, i: F.struct(i.alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens"))).alias("attachments"),
        F.aggregate("ts", F.lit(0).cast("bigint"), lambda s, t: s + t["n"]).alias("n_placeholder_tokens"), F.size("ts").cast("bigint").alias("n_turns"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct role, text (as written, placeholders included)."""
    blocks = F.filter(F.split(formatted, "<\\|turn\\|>"), lambda b, i: i > 0)
    strip = lambda b: F.substring(b, F.lit(1), F.length(b) - F.lit(len(END) + 1))

    def turn(b: Column) -> Column:
        at = F.instr(b, SEP)
        return F.struct(unescape(F.substring(b, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substring(strip(b), at + len(SEP), F.length(b))).alias("text"))
    return F.transform(blocks, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def brute_force(turns: list[tuple[str | None, str | None]]) -> str:
    """The formatted conversation of plain texts, in Python; for tests."""
    import re
    esc = lambda s: re.sub(_CONTROL, lambda m: m[0] + "\\", (s or "").replace("\\", "\\\\"))
    return "".join(f"{TURN}{esc(r)}{SEP}{esc(t)}{END}\n" for r, t in turns)


#: The result of query op2 in DuckDB.
ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *,
  length(regexp_replace(replace(role, '\', '\\'), '(<\||</?s>|\[/?INST\])', '\1?', 'g')) AS role_chars,
  length(regexp_replace(replace(text, '\', '\\'), '(<\||</?s>|\[/?INST\])', '\1?', 'g')) AS text_chars FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(8 + role_chars + 8 + text_chars + 7 + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
