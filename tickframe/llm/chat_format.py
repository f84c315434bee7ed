"""Chat formatting in budgeted windows, in DataFrame operations only.

A turn's cost is its number of blank-separated words and one for its marks. Turns are dealt to spans of at most
``budget`` by running sums; a window holds the leading system turn (if the conversation has one), as many of the turns
before its span as fit in ``history``, and the span. The loss mask covers the texts of the span's assistant turns; the
repeated ones before it are masked.

Running sums are taken within stretches of ``stretch`` turn numbers and continued by the stretches' totals, so a
conversation of any length is spread over tasks. Turns whose sums fall into the same ``blocks`` budgets are a block; spans
begin anew with each block, and a block's row has the turns before it that its first windows repeat. No array is longer
than a block.

A turn is written as `<s>role<|text|>text</s>`. In roles and texts `\\`, `<` and `[` become `\\0`, `\\1` and `\\2`, so no
mark can stand in a text, and the way back is exact.

Edges: null roles and texts are empty; a null conv_id is a conversation; equal (conv_id, turn) are ordered by role and
text, a null turn comes first; a turn above the budget has a span of its own; an empty table gives an empty result; other
columns are ignored. A conversation is a row of ``digests``, because its digest is of the whole conversation; its windows'
pieces, not its turns, are gathered for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, MIDDLE, END = "<s>", "<|text|>", "</s>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<"), F.lit("\\1")), F.lit("["), F.lit("\\2"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\2"), F.lit("[")), F.lit("\\1"), F.lit("<")), F.lit("\\0"), F.lit("\\"))


def placed(rows: DataFrame, stretch: int = 1024) -> DataFrame:
    """conv_id, role, text and cost of every turn, its number in the conversation and the costs before it."""
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    cost = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")) + 1
    turns = rows.select("conv_id", F.coalesce(F.floor(F.col("turn") / stretch), F.lit(-(1 << 62))).alias("part"), "turn", role.alias("role"), text.alias("text"), cost.cast("long").alias("cost"))
    own = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    local = turns.withColumns({"n": F.count(F.lit(1)).over(own), "sum": F.sum("cost").over(own)})
    earlier = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    totals = turns.groupBy(F.col("conv_id").alias("c"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("k"), F.sum("cost").alias("s"))
    totals = totals.select("c", "p", F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s0"))
    j = local.join(totals.hint("merge"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return j.select("conv_id", "role", "text", "cost", (F.col("n") + F.col("n0")).alias("n"), (F.col("sum") + F.col("s0") - F.col("cost")).alias("before"))


def windows(rows: DataFrame, budget: int = 256, history: int = 64, blocks: int = 16, stretch: int = 1024) -> DataFrame:
    """(conv_id, turn, role, text) -> a row per window: conv_id, block, window, n_repeated, formatted, loss (spans of code points)."""
    wide = max(blocks * budget, 2 * history)
    turns = placed(rows, stretch)
    block = F.floor(F.col("before") / wide)
    again = ((block + 1) * wide - F.col("before") <= history) & ((F.col("n") > 1) | (F.col("role") != "system"))  # the next block may repeat it
    both = turns.select("conv_id", "n", "role", "text", "cost", "before", block.alias("own"), F.explode(F.when(again, F.array(block, block + 1)).otherwise(F.array(block))).alias("block"))
    turn = F.struct("n", (F.col("block") == F.col("own")).alias("new"), "role", "text", "cost", "before")
    whole = both.select("conv_id", "block", turn.alias("t")).groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    first = F.get("turns", F.lit(0))
    leads = (F.col("block") == 0) & (first["n"] == 1) & (first["role"] == "system")
    whole = whole.withColumns({"rest": F.when(leads, F.slice("turns", F.lit(2), F.size("turns"))).otherwise(F.col("turns"))})
    whole = whole.withColumn("old", F.size(F.filter("rest", lambda t: ~t["new"]))).where((F.col("block") == 0) | (F.size("rest") > F.col("old")))
    system = turns.where("n = 1 and role = 'system'").select(F.col("conv_id").alias("_c"), F.struct("role", "text").alias("system"))
    conv = whole.select("conv_id", "block", "rest", "old").join(system.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    # span starts: the first turn that no longer fits after the last start
    begin = F.aggregate(
        F.when(F.size("rest") > F.col("old"), F.sequence(F.col("old"), F.size("rest") - 1)).otherwise(F.array().cast("array<int>")),
        F.array(F.col("old")),
        lambda acc, i: F.when((i > F.element_at(acc, -1)) & (F.get("rest", i)["before"] + F.get("rest", i)["cost"] - F.get("rest", F.element_at(acc, -1))["before"] > budget), F.concat(acc, F.array(i))).otherwise(acc),
    )
    conv = conv.withColumn("starts", begin)
    # every window takes its own turns along, and nothing else of the block
    start = lambda k: F.get("starts", k)
    stop = lambda k: F.coalesce(F.get("starts", k + 1), F.size("rest"))
    at = lambda k: F.get("rest", start(k))["before"]
    back = lambda k: F.filter(F.slice("rest", F.lit(1), start(k)), lambda t: at(k) - t["before"] <= history)
    one = F.transform(F.sequence(F.lit(0), F.size("starts") - 1), lambda k: F.struct(k.alias("window"), back(k).alias("back"), F.slice("rest", start(k) + 1, stop(k) - start(k)).alias("own")))
    each = conv.select("conv_id", "block", "system", F.explode(one).alias("w")).select("conv_id", "block", "w.window", "system", "w.back", F.col("w.own").alias("span"))
    piece = lambda t, new: F.struct(F.concat(F.lit(BEGIN), escape(t["role"]), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("body"), (F.lit(new) & (t["role"] == "assistant")).alias("target"))
    lead = F.when(F.col("system").isNotNull(), F.array(F.col("system"))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    parts = F.concat(F.transform(lead, lambda t: piece(t, False)), F.transform("back", lambda t: piece(t, False)), F.transform("span", lambda t: piece(t, True)))
    each = each.withColumn("parts", parts)
    # places of the targets: lengths of what stands before them, over the few turns of a window
    ahead = lambda i: F.aggregate(F.slice("parts", F.lit(1), i), F.lit(0), lambda acc, p: acc + F.length(p["head"]) + F.length(p["body"]) + len(END))
    spans = F.transform(F.col("parts"), lambda p, i: F.when(p["target"], F.struct((ahead(i) + F.length(p["head"])).alias("start"), (ahead(i) + F.length(p["head"]) + F.length(p["body"])).alias("stop"))))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    opens = (F.col("block") == 0) & (F.col("window") == 0)
    repeated = F.size("back") + F.when(opens | F.col("system").isNull(), 0).otherwise(1)
    return each.select("conv_id", "block", "window", repeated.alias("n_repeated"), text.alias("formatted"), F.filter(spans, lambda s: s.isNotNull()).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """Back from a window's text: its turns as role and text."""
    pieces = F.filter(F.split(formatted, F.lit(END)), lambda x: x != "")
    return F.transform(pieces, lambda p: F.struct(unescape(F.substring(F.get(F.split(p, r"<\|text\|>"), F.lit(0)), len(BEGIN) + 1, 1 << 30)).alias("role"), unescape(F.get(F.split(p, r"<\|text\|>"), F.lit(1))).alias("text")))


def digests(rows: DataFrame, budget: int = 256, history: int = 64, blocks: int = 16, stretch: int = 1024) -> DataFrame:
    """What every conversation's windows give when read back, in the contract's columns."""
    made = windows(rows, budget, history, blocks, stretch)
    turns = read_turns(F.col("formatted"))
    own = F.slice(turns, F.col("n_repeated") + 1, F.size(turns))
    masked = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["stop"] - s["start"]))), "")
    lines = F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = made.select("conv_id", F.struct("block", "window", lines.alias("lines"), masked.alias("masked")).alias("w"), (F.size(turns) - F.col("n_repeated")).alias("turns"), F.length("formatted").alias("chars"))
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"), F.sum("turns").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("w", lambda x: x["masked"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("w", lambda x: x["lines"]), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
