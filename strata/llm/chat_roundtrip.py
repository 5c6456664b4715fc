"""Chat formatting by grammar round trip (DataFrame functions only).

Grammar of a formatted conversation::

    conversation = turn*
    turn         = "<s>[" role "] " text " [/" role "]</s>"
    role         = a name of a-z, 0-9, _ and -, or "#" and the role's bytes in hex

A turn is rendered as it is, read back by the deterministic parser and compared with its
source. If anything differs, its text is escaped and the turn is rendered again, until
the turn read back is identical. Escaping puts one backslash more inside every control
string (``<s>`` becomes ``<\\s>``, ``<\\s>`` becomes ``<\\\\s>``); the parser takes one away
from each, so a text that has none needs no escaping, and any text can be restored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
# A control string: an opening bracket, backslashes, and the rest. `[x] ` and ` [/x]` need
# no escape: the parser finds them at the ends of a turn only.
CONTROL = r"<(\\*)(/?s>)"
ESCAPED = r"<\\(\\*)(/?s>)"
PLAIN_ROLE = r"\A[a-z0-9_-]+\z"
LOSS_ROLE = "assistant"
BLOCK = 512  # sums taken at a time


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"<\\$1$2"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("<$1$2"))


def role_token(role: Column) -> Column:
    return F.when(role.rlike(PLAIN_ROLE), role).otherwise(F.concat(F.lit("#"), F.hex(role.cast("binary"))))


def role_of(token: Column) -> Column:
    return F.when(token.startswith("#"), F.decode(F.unhex(F.substr(token, F.lit(2))), "UTF-8")).otherwise(token)


def render_turn(role: Column, text: Column) -> Column:
    token = role_token(role)
    return F.concat(F.lit(OPEN + "["), token, F.lit("] "), text, F.lit(" [/"), token, F.lit("]" + CLOSE))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums(sizes: Column, first: Column) -> Column:
    """``first`` and the running sums of ``sizes`` behind it, without the last. A step copies
    the array it adds to, so this is for short ones."""
    sums = F.aggregate(sizes, F.array(first), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    return F.slice(sums, F.lit(1), F.size(sizes))


def running_starts(sizes: Column) -> Column:
    """Where each of ``sizes`` (array of long) starts when they lie one behind the other.

    Summed in blocks of ``BLOCK``: first over whole blocks, then inside each. Time grows as
    the array times a block (and the square of the number of blocks), not as its square."""
    zero = F.lit(0).cast("long")

    def summed(blocks):
        totals = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda acc, n: acc + n))
        return F.flatten(F.zip_with(blocks, _sums(totals, zero), _sums))

    def cut(array):
        begins = F.when(F.size(array) > 0, F.sequence(F.lit(1), F.greatest(F.size(array), F.lit(1)), F.lit(BLOCK)))
        return _let(F.transform(F.coalesce(begins, F.array().cast("array<int>")), lambda b: F.slice(array, b, F.lit(BLOCK))), summed)

    return _let(sizes, cut)


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, raw, text, start).

    ``raw`` is the text as it stands in the output, from code point ``start`` (from 0) on."""
    def turn(piece, begin):
        token = F.regexp_extract(piece, r"^<s>\[([^\]]*)\] ", 1)
        head, tail = F.length(token) + len(OPEN) + 3, F.length(token) + 4
        raw = F.substr(piece, head + 1, F.length(piece) - head - tail)
        return F.struct(role_of(token).alias("role"), raw.alias("raw"), unescape(raw).alias("text"),
                        (begin + head).alias("start"))

    def turns(pieces):
        return F.zip_with(pieces, running_starts(F.transform(pieces, lambda p: (F.length(p) + len(CLOSE)).cast("long"))), turn)

    return _let(F.filter(F.split(formatted, CLOSE, -1), lambda p: p != ""), turns)


def _returns(rendered: Column, role: Column, text: Column) -> Column:
    """Whether a rendered turn is read back as exactly that one turn, with no start mark in its text."""
    back = F.get(parse(rendered), F.lit(0))
    return F.coalesce((F.length(rendered) == back["start"] + F.length(back["raw"]) + F.length(role_token(role)) + 4 + len(CLOSE))
                      & (back["role"] == role) & (back["text"] == text) & ~back["raw"].contains(OPEN), F.lit(False))


def format_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (array of start, end: code
    points of ``formatted`` that the loss covers), escaped_turns.

    Turns stand by ``turn`` (nulls first), ties by role, then text; repeated rows are
    repeated turns. Null roles and texts count as empty. Rows of null id are one
    conversation. A conversation is one training example and so one row: its turns are
    gathered, nothing else; time grows with its length, also for very long texts and very
    many turns. An empty table gives no row; other columns, of any name, are ignored. A
    turn that no escape restores stops the job (none is known).
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                        role.alias("role"), text.alias("text"))
    plain = rows.withColumn("plain", render_turn(F.col("role"), F.col("text")))
    tried = plain.withColumn("ok", _returns(F.col("plain"), F.col("role"), F.col("text")))
    again = tried.withColumn("safe", F.when(F.col("ok"), F.col("plain"))
                             .otherwise(render_turn(F.col("role"), escape(F.col("text")))))
    checked = again.withColumn("out", F.when(F.col("ok") | _returns(F.col("safe"), F.col("role"), F.col("text")), F.col("safe"))
                               .otherwise(F.raise_error(F.concat(F.lit("turn is not restored: "), F.col("safe"))).cast("string")))
    joined = (checked.groupBy("conv_id")
              .agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("z"), "turn", "role", "text", "out"))).alias("_t"),
                   F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("escaped_turns"))
              .select("conv_id", "escaped_turns", F.array_join(F.transform("_t", lambda t: t["out"]), "").alias("formatted")))
    spans = F.transform(F.filter(parse(F.col("formatted")), lambda t: t["role"] == loss_role),
                        lambda t: F.struct(t["start"].alias("start"), (t["start"] + F.length(t["raw"])).alias("end")))
    return joined.select("conv_id", "formatted", spans.alias("loss_spans"), "escaped_turns")


def read_back(formatted: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Digests of formatted conversations, from the output alone: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. The loss text is what ``loss_spans`` cover: a
    span that is the text of the turn it should be is taken from there, which takes one pass,
    any other is cut out of the output."""
    text = F.col("formatted")

    def covered(turn, span):
        same = (turn["start"] == span["start"]) & (turn["start"] + F.length(turn["raw"]) == span["end"])
        cut = F.substr(text, (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        return F.when(span.isNull(), F.lit("")).otherwise(unescape(F.when(same, turn["raw"]).otherwise(cut)))

    lossy = F.array_join(F.zip_with(F.filter("turns", lambda t: t["role"] == loss_role), "loss_spans", covered), "")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (formatted.withColumn("turns", parse(text)).withColumn("loss", lossy)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"),
                    F.col("escaped_turns").cast("long").alias("escaped_turns")))
