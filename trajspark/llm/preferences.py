"""Preference formatting: the turns that the chosen and the rejected conversation begin with in
common are rendered once as the prompt, the rest as two completions with loss masks.

Turns are arrays of (role, text). A mask lists the character ranges of a completion that are
trained: the texts and end marks of assistant turns. DataFrame functions only.
"""

from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import let

# The marks of a rendered turn.
OPEN, SHUT, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def _role(turn):
    return F.coalesce(turn["role"], F.lit(""))


def _text(turn):
    return F.coalesce(turn["text"], F.lit(""))


def rendered(turns):
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), _role(t), F.lit(SHUT), _text(t), F.lit(END))), "")


def trained_spans(turns):
    """start:end of what is trained in the rendered turns, in code points, comma-joined."""
    head = F.lit(len(OPEN) + len(SHUT))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done, turn):
        start = done["at"] + head + F.length(_role(turn))
        end = start + F.length(_text(turn)) + F.lit(len(END))
        own = F.array(F.concat(start.cast("string"), F.lit(":"), end.cast("string")))
        return F.struct(end.alias("at"), F.when(
            _role(turn) == TRAINED, F.concat(done["spans"], own)).otherwise(done["spans"])
            .alias("spans"))
    return F.aggregate(turns, state, step, lambda done: F.array_join(done["spans"], ","))


def common_turns(a, b):
    """How many turns from the start have the same role and text; nulls equal nulls."""
    size = F.least(F.size(a), F.size(b))
    differ = F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(1), size), lambda x, y: ~(
        x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])))
    return let(F.array_position(differ, True), lambda p: F.when(p > 0, p - 1).otherwise(size))


def preference_rows(pairs: DataFrame) -> DataFrame:
    """`chosen` and `rejected` turns -> n_prompt, prompt, chosen, rejected and the spans of both;
    all other columns stay.

    A null side counts as a conversation without turns, null roles and texts as empty ones. If
    one side begins with all of the other, or both are equal, that completion is empty and has
    no spans.
    """
    names = ("n_prompt", "prompt", "chosen_text", "rejected_text", "chosen_spans",
             "rejected_spans")
    clash = sorted({c.lower() for c in pairs.columns} & set(names))
    if clash:
        raise ValueError(f"columns {clash} would be replaced; rename them first")
    none = F.array().cast("array<struct<role:string,text:string>>")
    turn = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    a, b = (F.coalesce(F.transform(c, turn), none) for c in ("chosen", "rejected"))

    def sides(s):
        n = common_turns(s["a"], s["b"]).cast("int")

        def formatted(n):
            rest = [F.slice(s[c], n + 1, F.size(s[c])) for c in ("a", "b")]
            return F.struct(n.cast("long").alias("n_prompt"),
                            rendered(F.slice(s["a"], F.lit(1), n)).alias("prompt"),
                            rendered(rest[0]).alias("chosen_text"),
                            rendered(rest[1]).alias("rejected_text"),
                            trained_spans(rest[0]).alias("chosen_spans"),
                            trained_spans(rest[1]).alias("rejected_spans"))
        return let(n, formatted)
    found = pairs.withColumn("_found", let(F.struct(a.alias("a"), b.alias("b")), sides))
    kept = [F.col(f"`{c}`") for c in pairs.columns if c not in ("chosen", "rejected")]
    return found.select(*kept, *[F.col("_found")[n].alias(n) for n in names])


def reply_pairs(turns: DataFrame) -> DataFrame:
    """Pairs made of one table (conv_id, turn, role, text) without preferences: the conversation
    is chosen; rejected is the same up to its last assistant turn, which is answered with the
    text two turns before, or with the turn before where there is none. Conversations without an
    assistant turn are rejected without their last turn.

    Equal turns of a conversation are all kept, in the order of turn, role and text.
    """
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "text"))).alias("chosen"))

    def replaced(last):
        before = F.coalesce(F.get("chosen", last - 3)["text"], F.get("chosen", last - 2)["text"],
                            F.lit(""))
        turn = F.struct(F.lit(None).cast("long").alias("turn"), F.lit(TRAINED).alias("role"),
                        before.alias("text"))
        cut = F.slice("chosen", F.lit(1), last - 1)
        return F.when(last == 0, F.slice("chosen", F.lit(1), F.size("chosen") - 1)).otherwise(
            F.concat(cut, F.array(turn)))
    last = F.size("chosen") - F.array_position(
        F.reverse(F.transform("chosen", lambda t: _role(t) == TRAINED)), True) + 1
    last = F.when(F.exists("chosen", lambda t: _role(t) == TRAINED), last).otherwise(0)
    return grouped.withColumn("rejected", let(last.cast("int"), replaced))


ORACLE_SQL = """
WITH numbered AS (
  SELECT conv_id, role, text, row_number() OVER w AS k,
    count(*) OVER (PARTITION BY conv_id) AS n,
    max(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS replied
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
placed AS (
  SELECT *, CASE WHEN replied = 1 THEN max(CASE WHEN role = 'assistant' THEN k END)
      OVER (PARTITION BY conv_id) ELSE 0 END AS last FROM numbered),
said AS (
  SELECT p.conv_id, coalesce(
      max(text) FILTER (k = last - 2), max(text) FILTER (k = last - 1), '') AS reply
  FROM placed p GROUP BY p.conv_id),
turns AS (
  SELECT p.*, s.reply, CASE WHEN last = 0 THEN n - 1
      WHEN max(CASE WHEN k = last AND text = reply THEN 1 ELSE 0 END)
        OVER (PARTITION BY p.conv_id) = 1 THEN last ELSE last - 1 END AS shared
  FROM placed p JOIN said s USING (conv_id)),
shown AS (
  SELECT *, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>'
      || chr(10) AS body FROM turns),
ends AS (
  SELECT *, sum(length(body)) FILTER (k > shared) OVER (
      PARTITION BY conv_id ORDER BY k) AS stop FROM shown)
SELECT conv_id, CAST(any_value(shared) AS BIGINT) AS n_prompt,
  coalesce(string_agg(body, '' ORDER BY k) FILTER (k <= shared), '') AS prompt,
  coalesce(string_agg(body, '' ORDER BY k) FILTER (k > shared), '') AS chosen_text,
  CASE WHEN any_value(last) = any_value(shared) OR any_value(last) = 0 THEN ''
    ELSE '<|assistant|>' || chr(10) || any_value(reply) || '<|end|>' || chr(10)
    END AS rejected_text,
  coalesce(string_agg(CAST(stop - length(body) + length(role) + 5 AS VARCHAR) || ':'
      || CAST(stop AS VARCHAR), ',' ORDER BY k) FILTER (k > shared AND role = 'assistant'), '')
    AS chosen_spans,
  CASE WHEN any_value(last) = any_value(shared) OR any_value(last) = 0 THEN ''
    ELSE '14:' || CAST(14 + length(any_value(reply)) + 8 AS VARCHAR) END AS rejected_spans
FROM ends GROUP BY conv_id
"""
