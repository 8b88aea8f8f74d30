"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation's turns are written with markers, and texts that hold marker strings are escaped so that reading back
gives them exactly. Prefix sums of turn tokens cut a conversation into spans of whole turns: a turn
belongs to the span in which its last token falls. A window has the system turn, a few turns before its span, and the span's new
turns; its loss mask covers the texts of new assistant turns only, so every target counts once.

No window has more than BUDGET tokens. A turn of more than PART tokens is written in parts of that size, each a turn to the
windows, that read back as one. A span's new turns then have less than SPAN + PART tokens. The system turn is repeated if
it has SYSTEM tokens at most, and these three add up to the budget. Earlier turns are repeated, the nearest first, while differences of
the same prefix sums say that they fit.

A turn's markers have room for a role of one word. A role of more is written before the text, as part of what is counted and cut into parts; the turn's head then says
how many code points of it are the role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END, MORE, ROLE = "<|im_start|>", "<|im_end|>", "<|im_more|>", "<|im_role|>"
#: Tokens of a window, of one turn or part of a turn, and of a system turn that is repeated; markers of a turn included.
BUDGET, PART, SYSTEM = 1024, 512, 128
#: New turns end within so many tokens; turns repeated from before at most; tokens of a turn's markers.
SPAN, HISTORY, MARKERS = BUDGET - PART - SYSTEM, 2, 4

_SPACE = r"\x20\x09-\x0D"


def escaped(text: Column) -> Column:
    """``text`` without ``<|``: a backslash before each backslash, and between < and |."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """The text that escaped() was given: each backslash goes, and what follows it stays."""
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def tokens(text: Column) -> Column:
    """Words of a turn and its markers."""
    return F.regexp_count(text, F.lit(f"[^{_SPACE}]+")) + MARKERS


def parts(text: Column, most: int) -> Column:
    """The text in pieces of at most ``most`` words, cut before white space; joined, they are the text."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?:[{_SPACE}]*+[^{_SPACE}]++){{1,{most}}}+(?:[{_SPACE}]++\z)?"), F.lit(0))
    return F.when(tokens(text) - MARKERS <= most, F.array(text)).otherwise(pieces)


def windows(turns: DataFrame, budget: int = BUDGET, part: int = PART, system: int = SYSTEM, history: int = HISTORY) -> DataFrame:
    """(conv_id, lone, window, text, n_repeated, n_new, n_tokens, loss array of (start, length)) over ``turns`` (conv_id, turn, role, text).

    text is the window's formatted turns, n_tokens their tokens, ``budget`` at most. Its first n_repeated turns, parts counted as turns,
    were in an earlier window: the conversation's first turn if its role is system and it has at most ``system`` tokens, and up to
    ``history`` turns before the window's new ones. loss has the code points under the loss mask: the escaped text of
    each new assistant turn.

    Turns go by turn, role and text, nulls first. Null roles and texts read as empty. Repeated rows are turns of
    their own. A null conv_id is no conversation's: each of its rows is one of its own, equal rows together; lone tells them apart and is
    0 elsewhere. An empty table gives an empty one; other columns are ignored.
    """
    span = budget - part - system
    if min(span, part - MARKERS, system) <= 0:
        raise ValueError("part and system leave no room for new turns")
    own = W.partitionBy("conv_id", "lone")
    rows = turns.select("conv_id", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).otherwise(0).alias("lone"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("i", F.row_number().over(own.orderBy("turn", "role", "text")))
    wordy = tokens(F.col("role")) > MARKERS + 1
    said, mark = F.when(wordy, F.concat("role", F.lit("\n"), "text")).otherwise(F.col("text")), F.when(wordy, F.concat(F.lit(ROLE), F.char_length("role").cast("string"))).otherwise("")
    rows = rows.select("conv_id", "lone", "i", F.when(wordy, "").otherwise(F.col("role")).alias("role"), mark.alias("mark"), F.posexplode(parts(said, part - MARKERS)).alias("part", "text")).withColumn("tokens", tokens(F.col("text")))
    order = own.orderBy("i", "part")
    pinned = (F.col("i") == 1) & (F.col("role") == "system") & (F.col("tokens") <= system) & (F.col("part") == 0)
    before = order.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"pinned": pinned, "sum": F.sum("tokens").over(before)})
    rows = rows.withColumns({"w": F.floor((F.col("sum") - 1) / span).cast("int"), "system": F.first(F.when(F.col("pinned"), F.col("tokens")).otherwise(0)).over(before)})
    # Where the window of each turn ends, in tokens of the conversation.
    rows = rows.withColumn("end", F.max("sum").over(W.partitionBy("conv_id", "lone", "w")))
    fits = [F.when((F.lead("w", k).over(order) > F.col("w")) & (F.lead("end", k).over(order) - F.col("sum") + F.col("tokens") + F.col("system") <= budget), F.lead("w", k).over(order)) for k in range(1, history + 1)]
    rows = rows.withColumns({"ahead": F.array_distinct(F.array_compact(F.array(*fits))), "last": F.max("w").over(own)})
    # The windows in which a turn is read: its own, those in which it is history, all if it is the system turn.
    repeats = F.when(F.col("pinned"), F.expr("CASE WHEN last > w THEN sequence(w + 1, last) ELSE array() END")).otherwise(F.col("ahead"))
    role = F.regexp_replace(escaped(F.col("role")), "\n", "\\\\\n")
    head = F.concat(F.lit(START), F.when(F.col("part") > 0, MORE).otherwise(F.col("mark")), role, F.lit("\n"))
    rows = rows.select(
        "conv_id", "lone", "i", "part", "tokens", F.col("w").alias("own"), head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("target"),
        F.explode(F.concat(F.array("w"), repeats)).alias("window"),
    )
    rows = rows.withColumn("new", F.col("own") == F.col("window"))
    piece = F.struct("i", "part", F.concat("head", "body", F.lit(END + "\n")).alias("piece"), F.char_length("head").alias("head"), F.char_length("body").alias("body"), "target", "new")
    made = rows.groupBy("conv_id", "lone", "window").agg(F.sort_array(F.collect_list(piece)).alias("p"), F.count_if("new").alias("n_new"), F.sum("tokens").cast("int").alias("n_tokens"))
    # A conversation's numbering of spans may skip some that no turn ends in; a system turn alone is no window.
    made = made.filter("n_new > 0")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    loss = F.aggregate(
        "p",
        zero,
        lambda s, x: F.struct(
            (s["at"] + F.char_length(x["piece"])).alias("at"),
            F.when(x["new"] & x["target"], F.concat(s["loss"], F.array(F.struct((s["at"] + x["head"]).alias("start"), x["body"].alias("length"))))).otherwise(s["loss"]).alias("loss"),
        ),
        lambda s: s["loss"],
    )
    return made.select("conv_id", "lone", "window", F.array_join(F.col("p.piece"), "").alias("text"), (F.size("p") - F.col("n_new")).cast("int").alias("n_repeated"), F.col("n_new").cast("int").alias("n_new"), "n_tokens", loss.alias("loss"))


def read_back(made: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows, most_tokens) from windows() rows alone.

    turns_sha256 is the lowercase hex digest of role, line feed, text, line feed of each turn in order, loss_sha256
    that of the unescaped texts under the loss mask in order, loss_chars their code points, formatted_chars the
    code points of all windows, most_tokens those of the longest. The digest needs a conversation's whole text in one row.
    """
    # Markers can't occur inside a role or text: those hold no "<|".
    turn = F.slice(F.split("text", r"<\|im_end\|>\n"), F.col("n_repeated") + 1, F.col("n_new"))
    head = r"^<\|im_start\|>(<\|im_more\|>)?(<\|im_role\|>[0-9]+)?([^\\\n]*+(?:\\[\s\S][^\\\n]*+)*+)\n"
    more, wordy = (lambda t, k=k: F.regexp_extract(t, head, k) != "" for k in (1, 2))
    # A turn closes the one before it; a part goes on with it. What holds its role is role, line feed and text already.
    opened = lambda t: F.when(more(t), "").when(wordy(t), "\n").otherwise(F.concat(F.lit("\n"), unescaped(F.regexp_extract(t, head, 3)), F.lit("\n")))
    plain = F.transform(turn, lambda t: F.concat(opened(t), unescaped(F.regexp_replace(t, head, ""))))
    masked = F.transform("loss", lambda x: unescaped(F.substring(F.col("text"), x["start"] + 1, x["length"])))
    each = made.select(
        "conv_id", "lone", "window", F.size(F.filter(turn, lambda t: ~more(t))).alias("n"), F.array_join(plain, "").alias("turns"), F.array_join(masked, "").alias("loss"), F.char_length("text").alias("chars"), "n_tokens"
    )
    whole = each.groupBy("conv_id", "lone").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("x"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"), F.max("n_tokens").cast("long").alias("most_tokens")
    )
    loss = F.array_join(F.col("x.loss"), "")
    turns = F.concat(F.substr(F.array_join(F.col("x.turns"), ""), F.lit(2)), F.lit("\n"))
    return whole.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", "n_windows", "most_tokens",
    )
