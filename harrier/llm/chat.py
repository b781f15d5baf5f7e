"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only that reply is trainable. All
examples of a conversation are prefixes of its formatted text, so they are kept as spans of it: what is stored grows
with the text, not with the square of the turns. ``expand`` gives the examples as rows of text. Turns behind the last
reply belong to one further example without a target, so nothing of a conversation is lost.

Control strings inside roles and texts get a backslash behind their first character, one more than they have;
``unescape`` takes one off, so the change is reversible for every text.

Defined cases: null texts and roles are empty; rows with null conv_id are one conversation; null turns come first;
repeated turns go by role and text. A conversation without a reply has no loss. Very long conversations are one row, as
their digests need them whole. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import plain

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common templates, without their first character.
_CONTROL = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"
ESCAPE = rf"([<\[])(\\*)({_CONTROL})"
UNESCAPE = rf"([<\[])\\(\\*)({_CONTROL})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, r"$1$2$3")


def _role(role: Column) -> Column:
    """A role on one line."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unrole(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_conversations(turns: DataFrame, target: str = "assistant") -> DataFrame:
    """Per conversation: conv_id, formatted, turns (turn, trainable, start, stop: its text in formatted, in code
    points), examples (turn, nth: its place among the turns, loss_start, loss_stop, length: the prefix it is)."""
    t = plain(turns, "conv_id", "turn", "role", "text")
    t = t.withColumn("role", F.coalesce("role", F.lit(""))).withColumn("text", F.coalesce("text", F.lit("")))
    t = t.withColumn("head", F.concat(F.lit(OPEN), _role(F.col("role")), F.lit("\n"))).withColumn("body", escape(F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = F.length("head") + F.length("body") + len(CLOSE)
    t = t.withColumn("nth", F.row_number().over(order)).withColumn("end", F.sum(whole.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.col("end") - len(CLOSE)
    turn = F.struct(
        "nth",
        "turn",
        (F.col("role") == target).alias("trainable"),
        (stop - F.length("body")).alias("start"),
        stop.alias("stop"),
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
    )
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    spans = F.transform("all", lambda x: F.struct(x["nth"].alias("nth"), x["turn"].alias("turn"), x["trainable"].alias("trainable"), x["start"].alias("start"), x["stop"].alias("stop")))
    c = c.select("conv_id", F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"), spans.alias("turns"))
    examples = F.transform(
        F.filter("turns", lambda x: x["trainable"]),
        lambda x: F.struct(x["turn"].alias("turn"), x["nth"].alias("nth"), x["start"].alias("loss_start"), x["stop"].alias("loss_stop"), (x["stop"] + len(CLOSE)).alias("length")),
    )
    tail = F.array(F.struct(F.element_at("turns", -1)["turn"].alias("turn"), F.element_at("turns", -1)["nth"].alias("nth"), F.lit(None).cast("long").alias("loss_start"), F.lit(None).cast("long").alias("loss_stop"), F.length("formatted").cast("long").alias("length")))
    return c.withColumn("examples", F.concat(examples, F.when(F.element_at("turns", -1)["trainable"], F.slice(tail, 1, 0)).otherwise(tail)))


def expand(formatted: DataFrame) -> DataFrame:
    """The examples as rows for a trainer: conv_id, turn, context, target, closing. Texts as formatted; target null in the
    example without a reply. Contexts grow with the square of a conversation's turns; ``read_back`` has the targets alone."""
    e = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    cut = lambda a, b: F.substring(F.col("formatted"), a.cast("int") + 1, (b - a).cast("int"))
    zero = F.lit(0).cast("long")
    return e.select(
        "conv_id",
        F.col("e.turn").alias("turn"),
        cut(zero, F.coalesce("e.loss_start", "e.length")).alias("context"),
        cut(F.col("e.loss_start"), F.col("e.loss_stop")).alias("target"),
        cut(F.coalesce("e.loss_stop", "e.length"), F.col("e.length")).alias("closing"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What formatted texts and their examples say, as rows: of each turn (conv_id, nth, role, text), and of each example
    (conv_id, nth, example true, target: its reply, unescaped, null without one; length: of the whole example).

    A turn's place in the text comes from the pieces in front of it, and an example's target is cut from its turn's piece
    by its own span, so a span that is off gives another target. No row holds more than one turn's text, so a very long
    conversation costs no more than its length.
    """
    pieces = F.split("formatted", CLOSE.replace("|", r"\|"))
    pieces = F.posexplode(F.slice(pieces, 1, F.size(pieces) - 1))
    long = lambda: F.lit(None).cast("long")
    turns = formatted.select("conv_id", pieces.alias("nth", "piece")).select("conv_id", (F.col("nth") + 1).alias("nth"), F.lit(False).alias("example"), "piece", long().alias("loss_start"), long().alias("loss_stop"), long().alias("length"))
    e = formatted.select("conv_id", F.explode("examples").alias("e"))
    examples = e.select("conv_id", F.col("e.nth").alias("nth"), F.lit(True).alias("example"), F.lit(None).cast("string").alias("piece"), "e.loss_start", "e.loss_stop", "e.length")
    # an example comes behind its turn
    w = Window.partitionBy("conv_id").orderBy("nth", "example").rowsBetween(Window.unboundedPreceding, 0)
    both = turns.union(examples).withColumn("stop", F.sum((F.length("piece") + len(CLOSE)).cast("long")).over(w)).withColumn("of", F.last("piece", ignorenulls=True).over(w))
    start = F.col("stop") - F.length("of") - len(CLOSE)
    target = F.substring("of", (F.col("loss_start") - start + 1).cast("int"), (F.col("loss_stop") - F.col("loss_start")).cast("int"))
    return both.select(
        "conv_id",
        "nth",
        "example",
        _unrole(F.substring_index(F.substring("piece", len(OPEN) + 1, 1 << 30), "\n", 1)).alias("role"),
        unescape(F.substring("piece", F.instr("piece", "\n") + 1, F.length("piece"))).alias("text"),
        F.when(F.col("example"), unescape(target)).alias("target"),
        "length",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    in_order = lambda keep, value: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(keep, F.struct("nth", value.alias("said"))))), lambda x: x["said"]), "")
    turn = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    c = read_back(formatted).groupBy("conv_id").agg(
        F.count(F.when(~F.col("example"), True)).alias("n_turns"),
        F.sha2(in_order(~F.col("example"), turn), 256).alias("turns_sha256"),
        in_order(F.col("example") & F.col("target").isNotNull(), F.col("target")).alias("loss"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("formatted_chars"),
    )
    return c.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


#: The digests in DuckDB, from the turns and not from formatted text.
ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), l AS (
  SELECT *, {len(OPEN) + 1 + len(CLOSE)}
    + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '{ESCAPE}', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '{ESCAPE}', '\1\\\2\3', 'g')) AS chars
  FROM t
), e AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
    lead(turn) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NULL AS final
  FROM l
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR final) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
