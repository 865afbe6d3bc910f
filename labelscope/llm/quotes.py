"""Chat formatting by quotation linking, in DataFrame functions.

A line whose head (blanks and ``>``) holds n signs is quoted at level n; the rest of the line,
lower-cased with blanks folded, is hashed with SHA-256. A line quoted at level n stands for a
line at level n - 1 of the message it answers. Each quoted line votes for the latest earlier
message of its conversation that has that line at that level; a message replies to the one
with the most votes (ties: the later turn), or to none. Threads follow the replies: a message's
path lists the turns from its root down, and the result is range-sorted by conversation, path
and turn. Content is the message without its quoted lines, and ``formatted`` puts it in a
chat template.

Votes are taken per (conversation, level, line) and paths by doubling over linked messages
only, so neither a long conversation nor a line that all messages share is gathered.

A null text counts as empty; a null role is formatted as an empty one. Rows with a null
conv_id or turn have no links. A (conv_id, turn) that occurs again is one message of the thread
and comes back as often. Blank lines are neither quoted nor matched. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.runtime import stored

HEAD = "^[ \\t]*(?:>[ \\t]*)*"
QUOTED = "^[ \\t]*>"


def level_of(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, HEAD, 0), "[^>]", "")).cast("int")


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, HEAD, "")), "\\s+", " "))


def quoted_lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, line: each message's distinct lines at the level they have there."""
    return (
        messages.where("conv_id is not null and turn is not null")
        .select("conv_id", "turn", F.explode(F.split(F.coalesce("text", F.lit("")), "\\r?\\n")).alias("raw"))
        .select("conv_id", "turn", level_of(F.col("raw")).alias("level"), normal(F.col("raw")).alias("text"))
        .where("text <> ''")
        .select("conv_id", "turn", "level", F.sha2("text", 256).alias("line")).distinct()
    )


def reply_links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to of the messages that quote an earlier one."""
    quoting = messages.where(F.col("text").rlike("(?m)" + QUOTED)).select("conv_id").distinct()
    lines = quoted_lines(messages.join(quoting, "conv_id", "left_semi"))
    asked = lines.where("level > 0").select("conv_id", F.col("level") - 1, "line", "turn", F.lit(True))
    said = lines.select("conv_id", "level", "line", "turn", F.lit(False))
    both = asked.union(said).toDF("conv_id", "level", "line", "turn", "asks")
    earlier = Window.partitionBy("conv_id", "level", "line").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    votes = both.withColumn("reply_to", F.max(F.when(~F.col("asks"), F.col("turn"))).over(earlier)).where("asks and reply_to is not null")
    most = votes.groupBy("conv_id", "turn", "reply_to").agg(F.count("*").alias("n"))
    return most.groupBy("conv_id", "turn").agg(F.max(F.struct("n", "reply_to")).alias("best")).select(
        "conv_id", "turn", F.col("best.reply_to").alias("reply_to")
    )


def thread_paths(links: DataFrame) -> DataFrame:
    """conv_id, turn, path: the turns above each linked message, root first.

    Doubling: each round joins the messages to the chain above them and doubles its length.
    """
    chains = stored(links.select("conv_id", "turn", F.array("reply_to").alias("path"), F.col("reply_to").alias("top")), "chains")
    while True:
        above = chains.select("conv_id", F.col("turn").alias("top"), F.col("path").alias("_up"), F.col("top").alias("_top"))
        longer = chains.join(above, ["conv_id", "top"], "left")
        if longer.where("_up is not null").isEmpty():
            return chains.select("conv_id", "turn", "path")
        chains = stored(longer.select(
            "conv_id", "turn", F.when(F.col("_up").isNull(), F.col("path")).otherwise(F.concat("_up", "path")).alias("path"),
            F.coalesce("_top", "top").alias("top"),
        ), "chains")


def conversations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, reply_to, depth, thread, content, formatted in reply order."""
    links = stored(reply_links(messages), "reply-links")
    paths = stored(thread_paths(links).join(links, ["conv_id", "turn"]), "thread-paths")
    own = F.filter(F.split(F.coalesce("text", F.lit("")), "\\r?\\n"), lambda line: ~line.rlike(QUOTED))
    content = F.regexp_replace(F.array_join(own, "\n"), "^\\s+|\\s+$", "")
    turn = F.col("turn").cast("long")
    rows = messages.select("conv_id", "turn", "role", content.alias("content")).join(paths, ["conv_id", "turn"], "left")
    path = F.concat(F.coalesce("path", F.array().cast("array<bigint>")), F.array(turn))
    return (
        rows.withColumn("_path", path)
        .select(
            "conv_id", "turn", "role", F.col("reply_to").cast("long").alias("reply_to"), (F.size("_path") - 1).alias("depth"),
            F.array_join("_path", "/").alias("thread"), "content",
            F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("content"), F.lit("\n")).alias("formatted"), "_path",
        )
        .repartitionByRange("conv_id", "_path").sortWithinPartitions("conv_id", "_path", "turn").drop("_path")
    )
