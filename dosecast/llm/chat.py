r"""Chat formatting with typed content parts (operator 8).

A conversation's rows become one text.  A turn is ``### <role>: `` and its
content, then ``</turn>`` and a line break.  A turn's content is a list of typed
parts, flattened in order: text parts as escaped text, image, audio and
document parts as numbered placeholders ``<|image:3|>``; the references are
recorded in order with the number of tokens that each placeholder expands to.

Escaping is reversible and leaves no control string in a text: a backslash is
doubled, and one is put inside ``</turn>``, ``### `` and ``<|``; in a role also
after a colon that a space follows.  Removing one level of backslashes gives the text back.

Expanded tokens: an image one for each 14 x 14 patch begun, audio 25 for each
second begun, a document one for each 4 characters begun; 0 where the measure
is missing.

DataFrame functions only.  Defined cases: a null text or role is empty, a null
turn comes first; rows of one turn are ordered by role, then text, and repeated
rows are all kept; a part of unknown type or without one is text; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,n_chars:bigint>"
PATCH, AUDIO_RATE, CHARS_A_TOKEN = 14, 25, 4
END = "</turn>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    t = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control, cut in (("</turn>", 1), ("### ", 1), ("<|", 1)):
        t = F.replace(t, F.lit(control), F.lit(control[:cut] + "\\" + control[cut:]))
    return t


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """The content of a message that is text only."""
    none = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), none("string").alias("ref"), none("int").alias("width"),
                            none("int").alias("height"), none("double").alias("seconds"), none("bigint").alias("n_chars")))


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))


def expanded_tokens(part: Column) -> Column:
    patches = lambda side: F.ceil(side / PATCH)
    return F.coalesce(
        F.when(part["type"] == "image", patches(part["width"]) * patches(part["height"]))
         .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_RATE))
         .when(part["type"] == "document", F.ceil(part["n_chars"] / CHARS_A_TOKEN)), F.lit(0)).cast("long")


def turns(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, parts) -> one row a turn, in place: conv_id, n (from 1), role, head,
    content, attachments (type, ref, number, tokens), start (code points before the turn's content)."""
    m = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts"))
    m = m.withColumn("files", F.filter("parts", _is_attachment)).withColumn("order_key", F.to_json("parts"))
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "order_key")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("n", F.row_number().over(in_order)).withColumn(
        "files_before", F.coalesce(F.sum(F.size("files")).over(before), F.lit(0)))
    # The visitor: attachments numbered through the conversation, and between them runs of text parts, each
    # joined before it is escaped, as a control string can begin in one part and end in the next.
    m = m.withColumn("places", F.filter(F.transform("parts", lambda p, i: F.when(_is_attachment(p), i)), lambda i: i.isNotNull()))

    def step(k: Column) -> Column:
        begin = F.coalesce(F.get("places", k - 1) + 1, F.lit(0))
        run = F.slice("parts", begin + 1, F.coalesce(F.get("places", k), F.size("parts")) - begin)
        text = escape(F.array_join(F.transform(run, lambda p: F.coalesce(p["text"], F.lit(""))), ""))
        number = (F.col("files_before") + k + 1).cast("string")
        sign = F.concat(F.lit("<|"), F.get("files", k)["type"], F.lit(":"), number, F.lit("|>"))
        return F.concat(text, F.coalesce(sign, F.lit("")))
    shown = F.transform(F.sequence(F.lit(0), F.size("files")), step)
    files = F.transform("files", lambda p, i: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"), (F.col("files_before") + i + 1).cast("long").alias("number"),
        expanded_tokens(p).alias("tokens")))
    m = m.select("conv_id", "n", "role", F.concat(F.lit("### "), F.replace(escape(F.col("role")), F.lit(": "), F.lit(":\\ ")), F.lit(": ")).alias("head"),
                 F.array_join(shown, "").alias("content"), files.alias("attachments"))
    by_n = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("content") + len(END)
    return m.withColumn("start", F.coalesce(F.sum(length).over(by_n), F.lit(0)) + F.length("head"))


def format_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss (spans of trained content: start, length in code points), attachments,
    expanded_tokens."""
    t = turns(messages).select("conv_id", F.struct(
        "n", F.concat("head", "content", F.lit(END)).alias("shown"), F.col("start").cast("int").alias("start"),
        F.length("content").alias("length"), (F.col("role") == TRAINED_ROLE).alias("trained"), "attachments").alias("t"))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["trained"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    files = F.flatten(F.transform("t", lambda x: x["attachments"]))
    return c.select("conv_id", F.array_join(F.transform("t", lambda x: x["shown"]), "").alias("formatted"), spans.alias("loss"),
                    files.alias("attachments"), F.aggregate(files, F.lit(0).cast("long"), lambda s, x: s + x["tokens"]).alias("expanded_tokens"))


def parsed_turns(formatted: Column) -> Column:
    """(role, text) of every turn, read back; placeholders stay as they are."""
    turns_ = F.filter(F.split(formatted, "</turn>\n"), lambda x: x != "")
    def one(x: Column) -> Column:
        colon = F.locate(": ", x)
        # A role holds no colon before a space, so the first one ends it.
        return F.struct(unescape(F.substring(x, F.lit(5), colon - 5)).alias("role"),
                        unescape(F.substring(x, colon + 2, F.length(x))).alias("text"))
    return F.transform(turns_, one)


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id and checksums of what the formatted text and its loss mask give back."""
    t = parsed_turns(F.col("formatted"))
    every = F.array_join(F.transform(t, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return formatted.select("conv_id", F.size(t).cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
                            F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"),
                            F.length("formatted").cast("long").alias("formatted_chars"))
