r"""Chat formatting with a grammar round trip. DataFrame operations only.

A conversation is rendered turn by turn as `<s>[INST] role [/INST]\ntext</s>\n`. A deterministic parser reads the rendered text
back; any control string that is not where the grammar has one is an error. Turns that do not come back as they were
have their control strings escaped, and the conversation is rendered and parsed again, until all turns are identical.

Escape: `<`, `[`, then any backslashes, then `s>`, `/s>`, `INST]` or `/INST]` gets one more backslash; the parser takes one away.
It is one to one, leaves all other text alone, and an escaped text holds no control string, so two rounds always suffice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"[<\[]/?(?:s>|INST\])"
PLAIN = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*/?(?:s>|INST\]))"
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]\n", "</s>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def render(turns: Column) -> Column:
    """array<struct<role, text>> with escapes already made, as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")


def parse(rendered: Column) -> Column:
    """The turns of a rendered text, unescaped; a null turn where the grammar is violated."""
    pieces = F.slice(F.split(rendered, r"</s>\n", -1), F.lit(1), F.size(F.split(rendered, r"</s>\n", -1)) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, MIDDLE, 1)
        role = F.substring(head, F.lit(len(OPEN) + 1), F.length(head))
        text = F.substring(piece, F.length(head) + len(MIDDLE) + 1, F.length(piece))
        sound = piece.startswith(OPEN) & (F.length(head) < F.length(piece)) & ~role.rlike(CONTROL) & ~text.rlike(CONTROL)
        return F.when(sound, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))

    return F.transform(pieces, turn)


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows to (conv_id, turns), in order of turn; ties by role, then text; a null turn comes first.

    Null roles and texts are empty. A conversation becomes one value, as its rendered text must be one;
    everything else works on conversations in parallel, whatever their number.
    """
    item = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return listed.select("conv_id", F.transform("items", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def format_chats(chats: DataFrame) -> DataFrame:
    """`chats` (conv_id, turns) with `formatted`, `recovered` (its turns as parsed back), `identical` and `rounds`
    (0: nothing had to be escaped). Conversations without turns render as the empty text."""
    one = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), t["text"].alias("text")))
    first = chats.withColumn("formatted", render(one)).withColumn("recovered", parse(F.col("formatted")))

    def mend(source: Column, back: Column) -> Column:
        text = F.when(source["text"].eqNullSafe(back["text"]) & source["role"].eqNullSafe(back["role"]), source["text"]).otherwise(escape(source["text"]))
        return F.struct(escape(source["role"]).alias("role"), text.alias("text"))

    same = F.col("recovered").eqNullSafe(F.col("turns"))
    turns = F.slice("recovered", F.lit(1), F.size("turns"))
    two = first.withColumn("rounds", F.when(same, 0).otherwise(1)).withColumn("formatted", F.when(same, F.col("formatted")).otherwise(
        render(F.zip_with("turns", turns, mend)))).withColumn("recovered", F.when(F.col("rounds") == 0, F.col("recovered")).otherwise(parse(F.col("formatted"))))
    full = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    # A text with control strings may come back right by chance among shifted turns; then all texts are escaped.
    return two.withColumn("rounds", F.when(same, F.col("rounds")).otherwise(2)).withColumn("formatted", F.when(
        F.col("rounds") < 2, F.col("formatted")).otherwise(render(full))).withColumn(
        "recovered", F.when(F.col("rounds") < 2, F.col("recovered")).otherwise(parse(F.col("formatted")))).withColumn("identical", same)


def chat_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.sql(r"SELECT -1L AS conv_id, t.* FROM VALUES (0L, 'user', r'</s>[INST] ok [/INST]'), (1L, 'assistant', r'</s>[INST] ok [/INST]') AS t(turn, role, text)")
    done = format_chats(conversations(rows.unionByName(probe)))
    loss = F.array_join(F.transform(F.filter("recovered", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    told = F.array_join(F.transform("recovered", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("recovered").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "identical", "rounds")


_ESC = r"regexp_replace({}, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\2\\\3', 'g')"
CHAT_SQL = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t.* FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]')) AS t),
e AS (SELECT *, {_ESC.format('role')} AS er, {_ESC.format('text')} AS et FROM r),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
    string_agg('<s>[INST] ' || er || ' [/INST]' || chr(10) || et || '</s>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS formatted,
    bool_or(et <> text) AS escaped FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(length(formatted) AS BIGINT) AS formatted_chars, true AS identical, CAST(CASE WHEN escaped THEN 1 ELSE 0 END AS INTEGER) AS rounds FROM g
"""
