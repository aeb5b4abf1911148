"""Chat formatting: messages are rebuilt from an event log by folds, then rendered with an escaping template.

The log has one row per event: (conversation, sequence, message, kind, role, text).

* ``message`` sets a message's role and text, ``delta`` appends to its text, ``edit`` replaces its text;
* ``regenerate`` empties a message and takes back every later message begun before the event.

``fold_events`` turns the log into final messages with grouped aggregates, ``render`` joins them into one string
per conversation, ``parse`` and ``loss_spans`` read the string back. All of it is DataFrame functions.

Defined results: null text is empty text, null role is an empty role; a null conversation is a conversation of its
own, null sequences and messages come first; an event of unknown kind is ignored; events that tie on the sequence
are folded by kind, then text; an event that repeats in all columns counts again (a delta repeated is text repeated).
An empty log gives an empty result. Only the named columns are read, so extra columns cannot clash.

A conversation can hold a third of all rows: its messages are rendered in chunks of ``CHUNK`` messages in separate
tasks, and only finished pieces of text meet in the row of the conversation, which the output must hold anyway.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Messages whose numbers agree in ``message div CHUNK`` are rendered together.
CHUNK = 256

KINDS = ("message", "delta", "edit", "regenerate")


@dataclass(frozen=True)
class Template:
    """Marks around a turn: ``open`` role ``middle`` text ``close``.

    ``&`` and the first character of every control string are written as ``&`` name ``;`` in roles and texts, so no
    control string, of this template or of those listed in ``guarded``, can occur inside them.
    """

    open: str = "<|im_start|>"
    middle: str = "\n"
    close: str = "<|im_end|>\n"
    guarded: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    loss_role: str = "assistant"

    @property
    def escapes(self) -> list[tuple[str, str]]:
        """(character, escaped form) in the order of escaping; unescaping goes the other way round."""
        firsts = sorted({c[0] for c in (self.open, self.close, *self.guarded)} - {"&"})
        return [("&", "&amp;")] + [(c, f"&#{ord(c)};") for c in firsts]

    def escape(self, text: Column) -> Column:
        for plain, escaped in self.escapes:
            text = F.replace(text, F.lit(plain), F.lit(escaped))
        return text

    def unescape(self, text: Column) -> Column:
        for plain, escaped in reversed(self.escapes):
            text = F.replace(text, F.lit(escaped), F.lit(plain))
        return text

    def escape_role(self, role: Column) -> Column:
        """A role ends at ``middle``, so its line breaks are escaped as well."""
        return F.replace(self.escape(role), F.lit("\n"), F.lit("&#10;"))

    def unescape_role(self, role: Column) -> Column:
        return self.unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


CHATML = Template()


def from_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """A table of finished turns as a log. Rows that share a turn become messages of their own, by role and text."""
    log = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("seq"),
                       F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    again = F.collect_list(F.struct("role", "text"))
    same = log.groupBy("conv", "seq").agg(F.sort_array(again).alias("rows"))
    return same.select("conv", "seq", F.posexplode("rows").alias("part", "row")).select(
        "conv", F.col("seq").alias("message"), "part", "seq", F.lit("message").alias("kind"),
        F.col("row.role").alias("role"), F.col("row.text").alias("text"))


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages (conv, message, part, role, text) of a log (conv, message[, part], seq, kind, role, text).

    A message is what was set last (message, edit or regenerate) and every delta after it. Messages that a
    ``regenerate`` of an earlier message took back are gone, unless events after it write them anew.
    """
    part = F.col("part") if "part" in log.columns else F.lit(0)
    events = log.where(F.col("kind").isin(*KINDS)).select(
        "conv", "message", part.alias("part"), "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    back = events.where("kind = 'regenerate'").groupBy(F.col("conv").alias("b_conv")).agg(
        F.collect_set(F.struct(F.col("message").alias("m"), F.col("seq").alias("s"))).alias("backs"))
    joined = events.join(back, events["conv"].eqNullSafe(back["b_conv"]), "left")
    lost = F.exists("backs", lambda b: (F.col("message") > b["m"]) & (F.col("seq") < b["s"]))
    live = joined.where(~F.coalesce(lost, F.lit(False)))
    one = F.struct("seq", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("k"), "text", "role", "kind")
    grouped = live.groupBy("conv", "message", "part").agg(F.sort_array(F.collect_list(one)).alias("log"))
    # deltas are joined once at the end: the last reset and the slice after it
    resets = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i)))
    tail = grouped.withColumn("reset", F.coalesce(resets, F.lit(-1)))
    texts = F.transform(F.slice("log", F.greatest(F.col("reset"), F.lit(0)) + 1, F.size("log")),
                        lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    roles = F.array_compact(F.transform("log", lambda e: e["role"]))
    return tail.select("conv", "message", "part", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                       F.array_join(texts, "").alias("text"))


def render(messages: DataFrame, template: Template = CHATML) -> DataFrame:
    """(conv, formatted) from (conv, message, part, role, text), in the order of message and part."""
    turn = F.concat(F.lit(template.open), template.escape_role(F.col("role")), F.lit(template.middle),
                    template.escape(F.col("text")), F.lit(template.close))
    pieces = messages.select("conv", F.floor(F.col("message") / CHUNK).alias("chunk"), "message", "part",
                             turn.alias("turn"))
    chunks = pieces.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list(F.struct("message", "part", "turn")))
                                                 .alias("turns"))
    chunks = chunks.select("conv", "chunk", F.array_join(F.col("turns.turn"), "").alias("piece"))
    whole = chunks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "piece"))).alias("pieces"))
    return whole.select("conv", F.array_join(F.col("pieces.piece"), "").alias("formatted"))


def _raw_turns(formatted: Column, template: Template) -> Column:
    """The strings between ``open`` and ``close``; neither can occur inside a turn."""
    raw = F.split(formatted, r"\Q" + template.close + r"\E")
    return F.transform(F.slice(raw, 1, F.size(raw) - 1), lambda t: F.substring(t, len(template.open) + 1, 2**31 - 1))


def parse(rendered: DataFrame, template: Template = CHATML, formatted: str = "formatted") -> DataFrame:
    """``rendered`` with ``turns``: array of (role, text) read back from the string, unescaped."""
    role = lambda t: F.substring_index(t, template.middle, 1)
    # a role has no line break, so the text begins after the first one
    text = lambda t: F.substring(t, F.locate(template.middle, t) + len(template.middle), F.lit(2**31 - 1))
    raw = rendered.withColumn("_raw", _raw_turns(F.col(formatted), template))
    return raw.withColumn("turns", F.transform("_raw", lambda t: F.struct(
        template.unescape_role(role(t)).alias("role"), template.unescape(text(t)).alias("text")))).drop("_raw")


def loss_spans(rendered: DataFrame, template: Template = CHATML) -> DataFrame:
    """(conv, start, length) of the text that counts for the loss: code points in ``formatted``, one row per turn."""
    from pyspark.sql import Window

    raw = rendered.select("conv", F.posexplode(_raw_turns(F.col("formatted"), template)).alias("i", "turn"))
    around = len(template.open) + len(template.close)
    before = F.sum(F.length("turn") + around).over(
        Window.partitionBy("conv").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    head = F.length(F.substring_index("turn", template.middle, 1)) + len(template.middle)
    spans = raw.withColumn("start", F.coalesce(before, F.lit(0)) + len(template.open) + head).withColumn(
        "length", F.length("turn") - head)
    return spans.where(F.substring_index("turn", template.middle, 1) == template.loss_role).select(
        "conv", "start", "length")


def digests(rendered: DataFrame, template: Template = CHATML) -> DataFrame:
    """What is read back from each formatted string: counts and SHA-256 digests of its turns and of its loss text."""
    parsed = parse(rendered, template)
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == template.loss_role),
                                    lambda t: t["text"]), "")
    read = parsed.select("conv", F.size("turns").cast("long").alias("n_turns"), every.alias("every"),
                         loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select("conv", "n_turns", F.sha2("every", 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def format_log(log: DataFrame, template: Template = CHATML) -> DataFrame:
    """The whole operator: fold a log, render it. One row (conv, formatted) per conversation with a message left."""
    return render(fold_events(log), template)
