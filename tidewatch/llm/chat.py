"""Chat formatting: typed content parts become one marked text per conversation, natively.

Every turn is ``<|turn|>role<|text|>content<|end|>``. Content parts are flattened in order: text is escaped, an image,
audio or document part becomes a placeholder ``<|image|>``, ``<|audio|>``, ``<|document|>`` and is recorded as an
attachment with its expanded token count. Escaping (& first, then < and [) is reversible and leaves no < or [ in a
text, so no text can hold a control string of this or of the common bracket templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART = "struct<kind:string,text:string,ref:string,units:bigint>"
#: Tokens that one unit of an attachment expands to, and a fixed part for its borders. Units: image 28 x 28 pixel
#: patches, audio seconds, document pages.
EXPANSION = {"image": (1, 2), "audio": (25, 2), "document": (600, 4)}
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A text as a content of one part."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("bigint").alias("units"),
        )
    )


def _placeholder(part: Column) -> Column:
    """What a part becomes in the content: an unknown kind is kept as text, so nothing is lost."""
    shown = F.when(F.lit(False), F.lit(""))
    for kind in EXPANSION:
        shown = shown.when(part["kind"] == kind, F.lit(f"<|{kind}|>"))
    return shown.otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def _expanded(part: Column) -> Column:
    tokens = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for kind, (each, fixed) in EXPANSION.items():
        tokens = tokens.when(part["kind"] == kind, F.coalesce(part["units"], F.lit(0)) * each + fixed)
    return tokens


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "content",
    learn_from: str = "assistant",
) -> DataFrame:
    """One row per conversation: (conv, rendered array<string>, loss, attachments, expanded_tokens).

    ``content`` is ``array<struct<kind,text,ref,units>>``; ``rendered`` holds one marked string per turn (joined they are
    the formatted text); ``loss`` lists (turn index, start, length) in code points of the rendered turn for the
    content of ``learn_from`` turns; ``attachments`` lists (turn, place, kind, ref, tokens) in order.

    Turns stand in ascending (turn, role, content) order, null turns first; repeated rows are repeated turns. A null
    role is the empty role, null or empty content an empty text, a null conv one conversation of its own. Other
    columns are not read. A conversation is one training example, so its turns meet in one row.
    """
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(content), F.array().cast(f"array<{PART}>")).alias("parts"),
    )
    grouped = turns.groupBy(F.col(conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("_turns"))

    def body(t: Column) -> Column:
        return F.array_join(F.transform(t["parts"], _placeholder), "")

    with_body = grouped.select(
        conv,
        F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), body(t).alias("body"), t["parts"].alias("parts"))).alias("_t"),
    )
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    loss = F.filter(
        F.transform(
            "_t",
            lambda t, i: F.when(
                t["role"] == learn_from,
                F.struct(i.alias("turn"), F.length(head(t)).alias("start"), F.length(t["body"]).alias("length")),
            ),
        ),
        lambda s: s.isNotNull(),
    )
    attachments = F.flatten(
        F.transform(
            "_t",
            lambda t, i: F.filter(
                F.transform(
                    t["parts"],
                    lambda p, j: F.struct(
                        i.alias("turn"), j.alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), _expanded(p).alias("tokens")
                    ),
                ),
                lambda a: a["kind"].isin(*EXPANSION),
            ),
        )
    )
    out = with_body.select(
        conv,
        F.transform("_t", lambda t: F.concat(head(t), t["body"], F.lit(END))).alias("rendered"),
        loss.alias("loss"),
        attachments.alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("bigint"), lambda acc, a: acc + a["tokens"])
    return out.withColumn("expanded_tokens", total)


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns array<struct<role,text>>, loss_text, formatted_chars) parsed from ``format_chats`` output."""
    role = lambda r: unescape(F.substring_index(F.substring_index(r, TEXT, 1), TURN, -1))
    text = lambda r: unescape(F.substring_index(F.substring_index(r, TEXT, -1), END, 1))
    under_mask = F.transform(
        "loss", lambda s: unescape(F.substring(F.get(F.col("rendered"), s["turn"]), s["start"] + 1, s["length"]))
    )
    return formatted.select(
        conv,
        F.transform("rendered", lambda r: F.struct(role(r).alias("role"), text(r).alias("text"))).alias("turns"),
        F.array_join(under_mask, "").alias("loss_text"),
        F.aggregate("rendered", F.lit(0).cast("bigint"), lambda acc, r: acc + F.length(r)).alias("formatted_chars"),
    )


#: A conversation whose texts hold control strings of a common template.
PROBE_TEXT = "</s>[INST] ok [/INST]"


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user and an assistant turn that both say the probe text."""
    rows = F.array(*[F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))])
    return spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.explode(rows).alias("t")).select(
        "conv_id", "t.turn", "t.role", F.lit(PROBE_TEXT).alias("text")
    )


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and hashes of what ``read_back`` finds."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted, conv).select(
        conv,
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )
