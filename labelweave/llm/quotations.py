"""Chat formatting: quoted passages linked to the messages they come from, conversations in reply order.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stored

#: Turns of a thread that stand in one row of conversations(); longer threads take several rows.
BLOCK = 256
_MARKS = "^[\\x20\\t]*((?:>[\\x20\\t]?)*)"
_SPACES = "[\\x20\\x09-\\x0D]+"


def levels(lines: Column) -> Column:
    """The number of quote marks before each line."""
    return F.transform(lines, lambda x: F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 1), "[^>]", "")))


def contents(lines: Column) -> Column:
    """Each line without quote marks, A-Z lower-cased, white space as single spaces."""
    return F.transform(lines, lambda x: F.trim(F.regexp_replace(
        F.translate(F.regexp_replace(x, _MARKS, ""), UPPER, LOWER), _SPACES, " ")))


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash): normalised passages of messages (conv_id, turn, text), level 0 being their own.

    A passage is a run of lines of one level between blank lines or other levels; each line of a longer run
    counts as a passage too, so that partial quotes are found.
    """
    lined = messages.select("conv_id", "turn", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    lined = lined.select("conv_id", "turn", levels(F.col("lines")).alias("level"), contents(F.col("lines")).alias("said"))
    at = F.sequence(F.lit(0), F.size("said") - 1)

    def begins(i: Column) -> Column:
        level, said = F.col("level"), F.col("said")
        return (i == 0) | (level[i] != level[F.greatest(i - 1, F.lit(0))]) | (
            (said[i] == "") != (said[F.greatest(i - 1, F.lit(0))] == ""))

    runs = lined.withColumn("starts", F.filter(at, begins))
    runs = runs.withColumn("ends", F.concat(F.slice("starts", 2, F.size("said")), F.array(F.size("said"))))
    run = F.explode(F.arrays_zip("starts", "ends")).alias("run")
    runs = runs.select("conv_id", "turn", "level", "said", run).select(
        "conv_id", "turn", F.col("level")[F.col("run.starts")].alias("level"),
        F.slice("said", F.col("run.starts") + 1, F.col("run.ends") - F.col("run.starts")).alias("said"))
    whole = F.array(F.array_join("said", " "))
    units = F.when(F.size("said") > 1, F.concat(whole, F.col("said"))).otherwise(whole)
    return (runs.select("conv_id", "turn", "level", F.explode(units).alias("passage")).filter("passage <> ''")
            .select("conv_id", "turn", "level", F.sha2("passage", 256).alias("hash")))


def quotation_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, original, n): which earlier turns a message quotes, at which level, in n passages.

    The original of a passage is the first turn of the conversation that says it itself, so a passage that
    thousands say or quote is one row of the joined table.
    """
    found = stored(passages(messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")))
    own = found.filter("level = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("original"))
    quoted = found.filter("level > 0").distinct()
    return (quoted.join(own, ["conv_id", "hash"]).filter("original < turn")
            .groupBy("conv_id", "turn", "level", "original").agg(F.count("*").alias("n")))


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of parents (conv_id, turn, parent): jumps double, so long chains take few passes."""
    now = stored(parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        joined = now.join(up, ["conv_id", "root"], "left")
        after = stored(joined.select("conv_id", "turn", F.coalesce("higher", "root").alias("root"),
                                     (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                     F.col("higher").isNotNull().alias("moved")))
        if after.filter("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def without_quotes(text: Column) -> Column:
    """The text's own lines, without blank lines and spaces at either end; null stays null."""
    own = F.filter(F.split(text, "\n"), lambda x: ~x.rlike("^[\\x20\\t]*>"))
    return F.btrim(F.array_join(own, "\n"), F.lit(" \n"))


def reply_order(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parent, root, depth, n_quoted, text), one row per row of *messages*.

    parent is the message quoted at the lowest level; of several the one with most passages, then the latest. A
    message that quotes nothing known begins a thread: its parent is null and it is its own root. Parents are earlier,
    so sorting a conversation by (root, turn) puts every reply behind what it answers. n_quoted counts links.
    A row with a null conv_id or turn links with nothing; null texts have no passages and stay null; rows that
    repeat a turn share its links; other columns are ignored.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           "role", "text")
    links = quotation_links(rows)
    best = F.max_by("original", F.struct(-F.col("level"), F.col("n"), F.col("original")))
    parents = stored(links.groupBy("conv_id", "turn").agg(best.alias("parent"), F.sum("n").alias("n_quoted")))
    placed = threads(parents).join(parents, ["conv_id", "turn"])
    return rows.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "parent", F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
        F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"), without_quotes(F.col("text")).alias("text"))


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, root, block, messages): threads as arrays of (turn, role, parent, text) in reply order.

    A row holds the messages of BLOCK turns of a thread, so that a huge thread is many rows.
    """
    one = F.struct("turn", "role", "parent", "text")
    return (reply_order(messages).groupBy("conv_id", "root", F.expr(f"turn DIV {BLOCK}").alias("block"))
            .agg(F.sort_array(F.collect_list(one)).alias("messages")))
