"""Chat formatting by quotation linking.

Quoted lines (``>``, ``> >``, ``>>``) are parsed with their nesting level. A quoted
passage is a run of lines of one level; it and its single lines are normalised
(words only) and hashed, and joined to the message of the same conversation
that first wrote that line, paragraph or whole body in its own words, if it is
an earlier one. A message replies to the latest message linked at its
outermost linked level; without a link it replies to the message before it.
Reply order is (``depth``, ``turn``): every message stands after the one it
replies to. Quotes and the attribution line above one are left out of ``body``.

Quotes meet one original per hash (an aggregate), so a passage quoted by very
many messages never multiplies. Order inside a conversation is worked out in
runs of ``RUN`` turns and depth by pointer doubling over messages with links
only, so no conversation is collected into one task.

Defined cases: a null text has a null body and no quotes; null turns are left
as they are, without a reply or depth; null conversations are one conversation;
repeated rows are formatted alike; a message that only quotes has an empty
body; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.common import materialise

MIN_WORDS = 3                  # of a line or passage that may link
RUN = 4096
MARK = r"^[ \t]*(?:>[ \t]?)+"
ATTRIBUTION = r"(?i)^\s*(on\b.*\bwrote|.*\b(wrote|writes|said)|am\b.*\bschrieb.*|le\b.*\bécrit.*)\s*:\s*$"


def quote_level(line: Column) -> Column:
    """Number of quote marks at the start of a line."""
    mark = F.regexp_extract(line, MARK, 0)
    return F.length(F.regexp_replace(mark, "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """Message rows with ``lines``: array of (level, text without marks)."""
    lines = F.transform(F.split("text", "\r?\n"), lambda x: F.struct(
        quote_level(x).alias("level"), F.regexp_replace(x, MARK, "").alias("line")))
    return messages.withColumn("lines", lines)


def own_body(lines: Column) -> Column:
    """Lines of level 0 without attributions that stand above a quote."""
    kept = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(
        x["line"].rlike(ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)))
    body = F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
    return F.regexp_replace(F.regexp_replace(body, r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")


def _runs(lines: Column) -> Column:
    """(level, text) of runs of non-blank lines of one level."""
    step = F.aggregate(
        lines, F.struct(F.array().cast("array<struct<level:int,line:string>>").alias("done"),
                        F.lit(-1).alias("level"), F.lit("").alias("line")),
        lambda a, x: F.when(F.trim(x["line"]) == "", F.struct(
            F.when(a["level"] >= 0, F.concat(a["done"], F.array(F.struct(a["level"].alias("level"), a["line"].alias("line")))))
            .otherwise(a["done"]).alias("done"), F.lit(-1).alias("level"), F.lit("").alias("line")))
        .when(x["level"] == a["level"], F.struct(
            a["done"].alias("done"), a["level"].alias("level"), F.concat_ws(" ", a["line"], x["line"]).alias("line")))
        .otherwise(F.struct(
            F.when(a["level"] >= 0, F.concat(a["done"], F.array(F.struct(a["level"].alias("level"), a["line"].alias("line")))))
            .otherwise(a["done"]).alias("done"), x["level"].alias("level"), x["line"].alias("line"))),
        lambda a: F.when(a["level"] >= 0, F.concat(a["done"], F.array(F.struct(
            a["level"].alias("level"), a["line"].alias("line"))))).otherwise(a["done"]))
    return step


def _hashed(units: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash) of normalised units of MIN_WORDS words or more."""
    n = units.select("conv_id", "turn", "u.level", normalised(F.col("u.line")).alias("t"))
    n = n.filter(F.size(F.split("t", " ")) >= MIN_WORDS)
    return n.select("conv_id", "turn", "level", F.xxhash64("t").alias("h1"), F.xxhash64(F.lit("second"), "t").alias("h2"))


def quote_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source_turn): quoted passages and lines and the
    earlier message that first wrote them."""
    parsed = _parsed(messages).filter("turn is not null and text is not null")
    quoting = parsed.filter(F.exists("lines", lambda x: x["level"] > 0))
    quotes = quoting.select("conv_id", "turn", F.explode(F.filter(
        F.concat(_runs(F.col("lines")), F.col("lines")), lambda x: x["level"] > 0)).alias("u"))
    # only conversations with a quote can hold an original
    some = quoting.select("conv_id").distinct()
    own = F.filter("lines", lambda x: x["level"] == 0)
    body = F.array(F.struct(F.lit(0).alias("level"), F.array_join(F.transform(own, lambda x: x["line"]), " ").alias("line")))
    originals = parsed.join(some.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left_semi") \
        .select("conv_id", "turn", F.explode(F.concat(
            own, F.filter(_runs(F.col("lines")), lambda x: x["level"] == 0), body)).alias("u"))
    first = _hashed(originals).groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("source_turn")) \
        .withColumnRenamed("conv_id", "c")
    q = _hashed(quotes).distinct()
    return q.join(first, ["h1", "h2"]).filter(
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("source_turn") < F.col("turn"))) \
        .select("conv_id", "turn", "level", "source_turn").distinct()


def _order(turns: DataFrame) -> DataFrame:
    """(conv, turn, linked) -> previous turn, place and latest start of a run of
    unlinked replies, in runs of RUN turns. ``linked``: the turn replied to by link."""
    t = turns.withColumn("run", F.floor(F.col("turn") / RUN))
    inner = Window.partitionBy("conv", "run").orderBy("turn")
    t = t.select("*", F.lag("turn").over(inner).alias("p"), F.row_number().over(inner).alias("k"),
                 F.max(F.when(F.col("linked").isNotNull(), F.col("turn"))).over(inner).alias("s"))
    runs = t.groupBy("conv", "run").agg(F.max("turn").alias("last"), F.min("turn").alias("lowest"),
                                        F.count(F.lit(1)).alias("n"), F.max("s").alias("start"))
    outer = Window.partitionBy("conv").orderBy("run")
    earlier = outer.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv", "run", F.lag("last").over(outer).alias("p0"),
                       F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("k0"),
                       F.max("start").over(earlier).alias("s0"),
                       F.first("lowest").over(outer.rowsBetween(Window.unboundedPreceding, 0)).alias("root"))
    return t.join(runs, ["conv", "run"]).select(
        "conv", "turn", "linked", F.coalesce("p", "p0").alias("previous"), (F.col("k") + F.col("k0")).alias("place"),
        F.coalesce("s", "s0", "root").alias("head"))


def reply_order(messages: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, depth) of every distinct turn; ``conv`` is the id as
    text, or the text 'null' with a mark for the null conversation."""
    key = _key(F.col("conv_id"))
    links = quote_links(messages).select(key.alias("conv"), "turn", "level", "source_turn")
    chosen = links.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "source_turn")).alias("best"),
                                               F.count_distinct("source_turn").alias("n_linked"))
    turns = messages.filter("turn is not null").select(key.alias("conv"), "turn").distinct()
    order = materialise(_order(turns.join(chosen, ["conv", "turn"], "left").select(
        "conv", "turn", F.col("best.source_turn").alias("linked"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"))
        .drop("n_linked")), "order")
    # depth of the heads: a head replies to a message whose own head is known
    heads = order.filter("turn = head")
    at = order.select("conv", F.col("turn").alias("linked"), F.col("head").alias("anchor"), F.col("place").alias("to"))
    start = order.select("conv", F.col("turn").alias("anchor"), F.col("place").alias("base"))
    state = heads.join(at, ["conv", "linked"], "left").join(start, ["conv", "anchor"], "left").select(
        "conv", "head", "anchor", F.when(F.col("linked").isNull(), 0).otherwise(
            F.col("to") - F.col("base") + 1).cast("bigint").alias("depth"))
    state = materialise(state, "heads")
    while not state.filter("anchor is not null").isEmpty():
        up = state.select("conv", F.col("head").alias("anchor"), F.col("anchor").alias("above"), F.col("depth").alias("more"))
        state = materialise(state.join(up, ["conv", "anchor"], "left").select(
            "conv", "head", F.col("above").alias("anchor"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "heads")
    depth = state.join(order.select("conv", F.col("turn").alias("head"), F.col("place").alias("base")), ["conv", "head"])
    return order.join(depth, ["conv", "head"]).select(
        "conv", "turn", F.coalesce("linked", "previous").alias("reply_to"),
        F.col("linked").isNotNull().alias("by_quote"), (F.col("depth") + F.col("place") - F.col("base")).alias("depth"))


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per message (conv_id, turn, role, text): role, what it replies to and
    by which evidence, depth, number of quoted lines, and the body without quotes.
    A conversation is its rows in the order of (depth, turn)."""
    m = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    order = reply_order(m)
    rows = _parsed(m).select(
        "conv_id", "turn", "role", _key(F.col("conv_id")).alias("conv"),
        F.coalesce(F.size(F.filter("lines", lambda x: x["level"] > 0)), F.lit(0)).cast("long").alias("quoted_lines"),
        F.when(F.col("text").isNotNull(), own_body(F.col("lines"))).alias("body"))
    return rows.join(order, ["conv", "turn"], "left").select(
        "conv_id", "turn", "role", "reply_to", F.coalesce("by_quote", F.lit(False)).alias("by_quote"), "depth",
        "quoted_lines", "body")
