"""Chat formatting with typed content parts [native].

Every turn's content is a list of typed parts.  A visitor walks them in order:
text parts are escaped, image / audio / document parts become placeholders
repeated to their expanded token count, and their references are recorded.
The turn is then put between the template's marks.

Escaping is reversible: ``&``, ``<`` and ``[`` never appear raw in an escaped
text, and every mark of the template starts with ``<`` or ``[``, so a text can
not forge a mark.

Defined results: null text, role, part type or token count act as empty, text
and 1; turns are ordered by (turn, role, text), null turns first; rows of a null
conversation id form one conversation; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "[TURN]", "[SAYS]", "</s>"
PLACEHOLDER = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
PART_TYPE = "struct<type:string,text:string,ref:string,n_tokens:int>"


def escape(text: Column) -> Column:
    for raw, code in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in (("[", "&#91;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _visit(part: Column) -> Column:
    """One part as template text."""
    out = escape(F.coalesce(part["text"], F.lit("")))
    for kind, mark in PLACEHOLDER.items():
        n = F.greatest(F.coalesce(part["n_tokens"], F.lit(1)), F.lit(0))
        out = F.when(part["type"] == kind, F.repeat(F.lit(mark), n)).otherwise(out)
    return out


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``turns(conv_id, turn, role, parts array<struct type,text,ref,n_tokens>)``
    (or a ``text`` column in place of ``parts``) -> one row per conversation:
    ``formatted``, ``segments`` (array of struct(text, loss) whose texts joined are
    ``formatted``; ``loss`` marks what is trained on), ``attachments`` (array of
    struct(turn_no, part_no, type, ref, n_tokens)) and ``n_placeholder_tokens``."""
    if "parts" not in turns.columns:
        text_part = F.struct(
            F.lit("text").alias("type"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("n_tokens"))
        turns = turns.withColumn("parts", F.array(text_part))
    rows = turns.select(
        "conv_id", F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce(F.col("parts"), F.array().cast(f"array<{PART_TYPE}>")).cast(
            f"array<{PART_TYPE}>").alias("parts"))
    one = F.struct("turn", "role", "parts")
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    body = lambda t: F.concat_ws("", F.transform(t["parts"], _visit))
    seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        seg(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE)), F.lit(False)),
        seg(body(t), t["role"] == loss_role),
        seg(F.lit(CLOSE), F.lit(False)))))
    found = F.flatten(F.transform("turns", lambda t, i: F.filter(
        F.transform(t["parts"], lambda p, k: F.struct(
            i.alias("turn_no"), k.alias("part_no"), p["type"].alias("type"), p["ref"].alias("ref"),
            F.greatest(F.coalesce(p["n_tokens"], F.lit(1)), F.lit(0)).alias("n_tokens"))),
        lambda a: a["type"].isin(*PLACEHOLDER))))
    return (
        conv.select("conv_id", segments.alias("segments"), found.alias("attachments"))
        .withColumn("formatted", F.concat_ws("", F.transform("segments", lambda s: s["text"])))
        .withColumn("n_placeholder_tokens", F.aggregate(
            "attachments", F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"]))
    )


def read_back(chats: DataFrame) -> DataFrame:
    """``turns`` (array of struct(role, text)) parsed from ``formatted`` alone, and
    ``loss_text``: all text under the loss mask, unescaped."""
    pieces = F.filter(F.split("formatted", r"\[TURN\]"), lambda p, i: i > 0)
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, MIDDLE, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, MIDDLE, -1), CLOSE, 1)).alias("text")))
    loss = F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]),
                                       lambda s: unescape(s["text"])))
    return chats.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_text"))
