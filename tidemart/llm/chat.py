r"""Chat formatting with DataFrame expressions only.

A conversation becomes one string: for each run of turns of one role a header
``### role:`` and a line feed, then each turn's text closed by ``</turn>`` and
a line feed.  Texts and roles can't forge markers: a backslash, ``<`` and ``#``
(in roles also ``:``) are written as ``\b``, ``\l``, ``\h`` and ``\c``, so every
backslash is followed by its code and the escape is undone by plain
replacements.  The loss mask says for each turn how many code points are
skipped, trained and passed over; only assistant texts are trained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEADER, HEADER_END, TURN_END = "### ", ":\n", "</turn>\n"
#: Fixed order: the backslash is escaped first and restored last.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escape(x: Column, role: bool = False) -> Column:
    for plain, code in ESCAPES if role else ESCAPES[:3]:
        x = F.replace(x, F.lit(plain), F.lit(code))
    return x


def unescape(x: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        x = F.replace(x, F.lit(code), F.lit(plain))
    return x


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) for each conversation of ``turns(conv_id, turn, role, text)``.

    Turns are ordered by turn, null last, ties by role, then text; repeated
    rows are turns of their own.  A null text or role is empty; rows with a null
    conv_id form one conversation.  ``mask`` has (skip, keep, rest) code points
    for each turn; their sums cover ``formatted``.  Other columns are ignored;
    an empty table gives an empty result.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select("conv_id", F.struct(
        F.col("turn").isNull().alias("late"), "turn", escape(role, True).alias("role"), escape(text).alias("text"),
        (role == "assistant").alias("trained")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    before = lambda i: F.get("turns", i - 1)["role"]
    opened = sorted_turns.withColumn("opens", F.transform("turns", lambda t, i: ~F.coalesce(before(i) == t["role"], F.lit(False))))
    starts = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: F.get("opens", i))
    runs = opened.withColumn("starts", starts).withColumn("blocks", F.transform("starts", lambda s, k: F.struct(
        F.get("turns", s)["role"].alias("role"),
        F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s).alias("own"))))
    body = lambda b: F.array_join(F.transform(b["own"], lambda t: F.concat(t["text"], F.lit(TURN_END))), "")
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(F.lit(HEADER), b["role"], F.lit(HEADER_END), body(b))), "")
    head = lambda t, i: F.when(F.get("opens", i), F.length(t["role"]) + len(HEADER + HEADER_END)).otherwise(0)
    mask = F.transform("turns", lambda t, i: F.struct(
        (head(t, i) + F.when(t["trained"], 0).otherwise(F.length(t["text"]))).alias("skip"),
        F.when(t["trained"], F.length(t["text"])).otherwise(0).alias("keep"), F.lit(len(TURN_END)).alias("rest")))
    return runs.select("conv_id", formatted.alias("formatted"), mask.alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What ``format_conversations`` wrote, read from its text and mask alone:
    conv_id, turns (array of role and text), loss (all trained text) and formatted."""
    blocks = F.transform(F.filter(F.split("formatted", HEADER), lambda b, i: i > 0), lambda b: F.struct(
        F.substring_index(b, HEADER_END, 1).alias("role"),
        F.split(b.substr(F.length(F.substring_index(b, HEADER_END, 1)) + 1 + len(HEADER_END), F.length(b)), TURN_END).alias("texts")))
    turns = F.flatten(F.transform("blocks", lambda b: F.transform(
        F.filter(b["texts"], lambda x, i: i < F.size(b["texts"]) - 1),
        lambda x: F.struct(unescape(b["role"]).alias("role"), unescape(x).alias("text")))))
    trained = F.zip_with("mask", F.split("formatted", TURN_END), lambda m, part: F.when(
        m["keep"] > 0, F.substring(part, m["skip"] + 1, m["keep"])).otherwise(""))
    return (formatted.withColumn("blocks", blocks)
            .select("conv_id", turns.alias("turns"), unescape(F.array_join(trained, "")).alias("loss"), "formatted"))


def digests(turns: DataFrame) -> DataFrame:
    """One row of counts and digests a conversation, read back from the formatted output."""
    back = read_back(format_conversations(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
