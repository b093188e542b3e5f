"""Chat formatting with a checked grammar round trip, in DataFrame expressions only.

    conversation = turn*
    turn         = "<s>" role mark newline body "</s>"
    mark         = "" (text as it is) | "|e" (text escaped)
    body         = "[INST] " text " [/INST]"  for the role user,  text  for every other role

Every turn is rendered as it is, read again by the parser and compared with its source. The parser is
strict: between its marks no control string (``CONTROL``) may occur. A turn that doesn't come back
identical is rendered again with its text escaped, and the comparison decides again; a whole
conversation that doesn't come back is an error, never a silent change.
The loss mask is the list of spans (code points, end exclusive) of assistant texts.

Defined cases: null role or text is empty; turns are ordered by turn, then role, then text (null
first), so repeated turns stay; a null conv_id is a conversation of its own; an empty table gives no
row; other columns are ignored. One conversation becomes one string and must fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL_RX = r"</?s>|\[/?INST\]"
OPEN, CLOSE, USER_OPEN, USER_CLOSE, MARK = "<s>", "</s>", "[INST] ", " [/INST]", "|e"


def _replace(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(text: Column) -> Column:
    """No control string is left, and ``unescape`` gives the text back: & is escaped first and read last."""
    return _replace(text, [("&", "&amp;"), *((s, ("&lt;" if s[0] == "<" else "&#91;") + s[1:]) for s in CONTROL)])


def unescape(text: Column) -> Column:
    return _replace(text, [("&lt;", "<"), ("&#91;", "["), ("&amp;", "&")])


def escape_role(role: Column) -> Column:
    return _replace(escape(role), [("|", "&#124;"), ("\n", "&#10;")])


def unescape_role(role: Column) -> Column:
    return unescape(_replace(role, [("&#124;", "|"), ("&#10;", "\n")]))


def render(role: Column, text: Column, escaped: bool) -> Column:
    body = escape(text) if escaped else text
    body = F.when(role == "user", F.concat(F.lit(USER_OPEN), body, F.lit(USER_CLOSE))).otherwise(body)
    return F.concat(F.lit(OPEN), escape_role(role), F.lit((MARK if escaped else "") + "\n"), body, F.lit(CLOSE))


def parse_segment(segment: Column) -> Column:
    """A turn without its close -> struct(role, text); null where the grammar doesn't hold."""
    head = F.substring_index(segment, "\n", 1)
    escaped = head.endswith(MARK)
    name = head.substr(F.lit(len(OPEN) + 1), F.length(head) - len(OPEN) - F.when(escaped, len(MARK)).otherwise(0))
    body = segment.substr(F.length(head) + 2, F.length(segment))
    user = name == "user"
    wrapped = body.startswith(USER_OPEN) & body.endswith(USER_CLOSE) & (F.length(body) >= len(USER_OPEN) + len(USER_CLOSE))
    text = F.when(user, body.substr(F.lit(len(USER_OPEN) + 1), F.length(body) - len(USER_OPEN) - len(USER_CLOSE))).otherwise(body)
    sound = segment.startswith(OPEN) & (segment.contains("\n")) & (~user | wrapped) & ~text.rlike(_CONTROL_RX)
    return F.when(sound, F.struct(unescape_role(name).alias("role"), F.when(escaped, unescape(text)).otherwise(text).alias("text")))


def parse(formatted: Column) -> Column:
    """A formatted conversation -> array of struct(role, text), null for a segment outside the grammar."""
    segments = F.split(formatted, CLOSE)
    return F.transform(F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0))), parse_segment)


def returns(rendered: Column, role: Column, text: Column) -> Column:
    """Whether one rendered turn is read again as exactly one turn with this role and text."""
    got = parse(rendered)
    return rendered.endswith(CLOSE) & (F.size(got) == 1) & F.coalesce((got[0]["role"] == role) & (got[0]["text"] == text), F.lit(False))


def format_chat(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, n_turns, loss_spans (array of start, end, escaped)."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain = render(F.col("role"), F.col("text"), False)
    turns = turns.withColumn("escaped", ~returns(plain, F.col("role"), F.col("text")))
    turns = turns.withColumn("rendered", F.when(F.col("escaped"), render(F.col("role"), F.col("text"), True)).otherwise(plain))
    order = Window.partitionBy("conv_id").orderBy(*(F.col(c).asc_nulls_first() for c in ("turn", "role", "text")))
    end = F.sum(F.length("rendered").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    closing = F.length(F.lit(CLOSE)) + F.when(F.col("role") == "user", len(USER_CLOSE)).otherwise(0)
    shown = F.when(F.col("escaped"), F.length(escape(F.col("text")))).otherwise(F.length("text"))
    placed = turns.select("conv_id", F.row_number().over(order).alias("at"), end.alias("stop"), "role", "text", "rendered", "escaped", closing.alias("closing"), shown.alias("shown"))
    listed = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "at", "role", "text", "rendered", "escaped", (F.col("stop") - F.col("closing") - F.col("shown")).alias("start"), (F.col("stop") - F.col("closing")).alias("end")))).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: t["rendered"]), "")
    spans = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["escaped"].alias("escaped")))
    out = listed.select("conv_id", formatted.alias("formatted"), F.size("turns").cast("long").alias("n_turns"), spans.alias("loss_spans"),
                        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    same = parse(F.col("formatted")) == F.col("source")
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.concat(F.lit("no round trip for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return out.select("conv_id", checked.alias("formatted"), "n_turns", "loss_spans")


def read_chat(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) parsed from the text, loss_text (unescaped, by the mask)."""
    covered = F.transform("loss_spans", lambda s: F.struct(
        F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).alias("text"), s["escaped"].alias("escaped")))
    loss = F.array_join(F.transform(covered, lambda c: F.when(c["escaped"], unescape(c["text"])).otherwise(c["text"])), "")
    return formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), loss.alias("loss_text"))
