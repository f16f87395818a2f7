"""Chat formatting with typed content parts (operator 5).

A turn's content is an array of typed parts (text, image, audio,
document).  A visitor flattens the parts, in order, into one string:
text parts are escaped, every other part becomes a numbered placeholder
``<image:0/>``.  What a placeholder stands for is recorded beside the
string: the reference, and the number of tokens it expands to.

The template writes a turn as ``<turn:ROLE>BODY</turn>\\n``.  ``&``, ``<``
and ``>`` inside roles and texts are written ``&amp;``, ``&lt;`` and
``&gt;``, so no text can hold a control string, and reading back is exact.
The loss mask is the list of spans (code points, end exclusive) that the
bodies of the trained role's turns take up.

A conversation is one record of the output, so its rows meet in one task;
that is bounded by the longest conversation, not by the table.

Defined cases: null text and null or empty parts give an empty body; a null
role is the empty role; an unknown part kind becomes an ``unknown``
placeholder of no tokens; null sizes of a part count as 0; turns of equal
number are ordered by role, then body; repeated rows stay repeated; a null
conversation id is a conversation of its own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
TURN_OPEN, TURN_SHUT, TURN_END = "<turn:", ">", "</turn>\n"
ENTITIES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]

PARTS = ("array<struct<kind:string,text:string,ref:string,width:long,height:long,"
         "seconds:double,pages:long>>")


@dataclass(frozen=True)
class TokenRates:
    """How many tokens an attachment expands to."""

    image_patch: int = 28
    audio_per_second: float = 12.5
    document_page: int = 600


def escape(c: Column) -> Column:
    for plain, written in ENTITIES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescape(c: Column) -> Column:
    for plain, written in reversed(ENTITIES):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return c


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"))
                   ).cast("array<struct<kind:string,text:string>>")


class PartVisitor:
    """Flattens content parts; one method per kind gives (written form, tokens).

    ``fields`` are the field names that the part struct has, so that a
    narrower struct (text only) needs no unused sizes.
    """

    ATTACHED = ("image", "audio", "document")

    def __init__(self, fields: list[str], rates: TokenRates = TokenRates()):
        self.fields, self.rates = fields, rates

    def _field(self, part: Column, name: str, kind: str) -> Column:
        return part[name] if name in self.fields else F.lit(None).cast(kind)

    def tokens(self, part: Column) -> Column:
        r = self.rates
        size = lambda n: F.coalesce(self._field(part, n, "long"), F.lit(0)).cast("long")
        patches = lambda n: F.ceil(size(n) / F.lit(r.image_patch))
        seconds = F.coalesce(self._field(part, "seconds", "double"), F.lit(0.0))
        return (F.when(part["kind"] == "image", patches("width") * patches("height"))
                .when(part["kind"] == "audio", F.ceil(seconds * F.lit(r.audio_per_second)))
                .when(part["kind"] == "document", size("pages") * F.lit(r.document_page))
                .otherwise(F.lit(0))).cast("long")

    def attachments(self, parts: Column) -> Column:
        """The non-text parts in order: index in the content, kind, reference, tokens."""
        every = F.transform(parts, lambda p, i: F.struct(
            i.alias("part"), F.coalesce(p["kind"], F.lit("unknown")).alias("kind"),
            self._field(p, "ref", "string").alias("ref"), self.tokens(p).alias("tokens")))
        return F.filter(every, lambda a: a["kind"] != "text")

    def written(self, parts: Column) -> Column:
        """The content as one string, texts escaped, placeholders numbered by part."""
        known = lambda p: F.when(p["kind"].isin(*self.ATTACHED), p["kind"]).otherwise("unknown")
        return F.array_join(F.transform(parts, lambda p, i: F.when(
            p["kind"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<"), known(p), F.lit(":"), i.cast("string"), F.lit("/>")))), "")


def format_conversations(turns: DataFrame, parts: str = "parts", conv: str = "conv_id",
                         turn: str = "turn", role: str = "role", loss_role: str = "assistant",
                         rates: TokenRates = TokenRates()) -> DataFrame:
    """One row per conversation: formatted string, loss spans, attachments, token count.

    ``parts`` names a column of content parts (``PARTS``, or a narrower
    struct that has ``kind`` and ``text``).
    """
    fields = turns.schema[parts].dataType.elementType.fieldNames()
    visit = PartVisitor(fields, rates)
    content = F.coalesce(F.col(parts), F.array().cast(turns.schema[parts].dataType))
    who = F.coalesce(F.col(role), F.lit(""))
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"),
        visit.written(content).alias("body"), visit.attachments(content).alias("attached"))
    if not set(fields) - {"kind", "text"}:
        rows = rows.withColumn("attached", F.filter("attached", lambda a: F.lit(True)))
    head = F.concat(F.lit(TURN_OPEN), escape(F.col("role")), F.lit(TURN_SHUT))
    rows = rows.withColumn("head", head).withColumn(
        "written", F.concat("head", "body", F.lit(TURN_END)))
    before = (Window.partitionBy("conv_id").orderBy("turn", "role", "body")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn(
        "start", F.coalesce(F.sum(F.length("written").cast("long")).over(before), F.lit(0)))
    from_ = F.col("start") + F.length("head")
    rows = rows.select(
        "conv_id",
        F.struct("start", "written", (F.col("role") == loss_role).alias("trained"),
                 from_.alias("from"), (from_ + F.length("body")).alias("to"),
                 "attached").alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: t["written"]), "").alias("formatted"),
        F.transform(F.filter("ts", lambda t: t["trained"]),
                    lambda t: F.struct(t["from"].alias("start"), t["to"].alias("end"))
                    ).alias("loss_spans"),
        F.flatten(F.transform("ts", lambda t, i: F.transform(
            t["attached"], lambda a: F.struct(i.alias("turn_no"), a["part"].alias("part"),
                                              a["kind"].alias("kind"), a["ref"].alias("ref"),
                                              a["tokens"].alias("tokens"))))).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """Roles and texts of a formatted string, in order (placeholders stay as written)."""
    pieces = F.split(formatted, TURN_END)
    bodies = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(p: Column) -> Column:
        shut = F.instr(p, TURN_SHUT)
        return F.struct(
            unescape(F.substring(p, F.lit(len(TURN_OPEN) + 1), shut - 1 - len(TURN_OPEN))
                     ).alias("role"),
            unescape(F.substring(p, shut + 1, F.length(p))).alias("text"))

    return F.transform(bodies, one)


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of what can be read back from formatted conversations."""
    turns = formatted.withColumn("_turns", read_turns(F.col("formatted"))).withColumn(
        "_loss", read_loss_text(F.col("formatted"), F.col("loss_spans")))
    nl = F.lit("\n")
    told = F.array_join(F.transform(
        "_turns", lambda t: F.concat(t["role"], nl, t["text"], nl)), "")
    return turns.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
