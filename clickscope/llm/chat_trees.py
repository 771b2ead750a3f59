"""Chat formatting from reply trees.

Messages form trees by (tree, node, parent). Iterative self-joins double every message's ancestor pointer:
after k rounds a pointer leads 2^k steps up and has gathered the depth and the score of that stretch, so
the rounds grow with the logarithm of the longest path. Every leaf then has the depth and score of its
root-to-leaf path; the branches of a tree are ranked by mean score, and the best `branches` are kept. The
pointers are walked again from the chosen leaves to list all messages of each path, which is formatted as
one conversation.

Template: <s>role, newline, text, </s>, newline per turn. In role and text a backslash is put after every
backslash, < and [, so no control string (this template's or another's that begins with < or [) survives
inside a text, and the escape is undone by dropping it. Loss spans cover the texts of the trained roles.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickscope.llm.common import let, once, settle

TRAINED = ("assistant",)
OPEN, CLOSE = "<s>", "</s>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def _climb(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(pointer tables by round, last table): tree, node, up, steps, sum. A parent that does not exist makes
    a message a root. Messages on or under a cycle never reach a root and are left out."""
    nodes = messages.select(F.col("tree").alias("_t"), F.col("node").alias("_p")).distinct()
    state = settle(
        messages.join(nodes, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_p")), "left")
        .select("tree", "node", F.col("_p").alias("up"), F.lit(1).cast("long").alias("steps"),
                F.coalesce("score", F.lit(0.0)).cast("double").alias("sum")), "chat-up")
    levels, open_ = [state], state.where("up is not null").count()
    limit = max(1, state.count()).bit_length() + 1
    while open_ and len(levels) <= limit:
        above = state.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_u"),
                             F.col("steps").alias("_s"), F.col("sum").alias("_m"))
        state = settle(
            state.join(above, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("up") == F.col("_n")), "left")
            .select("tree", "node", F.col("_u").alias("up"), (F.col("steps") + F.coalesce("_s", F.lit(0))).alias("steps"),
                    (F.col("sum") + F.coalesce("_m", F.lit(0.0))).alias("sum")), "chat-up")
        levels.append(state)
        open_ = state.where("up is not null").count()
    return levels, state.where("up is null")


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree, leaf, rank, node: all messages of the best root-to-leaf paths of every tree.

    messages: tree, node (unique in its tree), parent, score. Rank: mean score, then the longer path, then
    the smaller leaf.
    """
    levels, tops = _climb(messages)
    parents = messages.where("parent is not null").select(F.col("tree").alias("_t"), F.col("parent").alias("_p")).distinct()
    leaves = tops.join(parents, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_p")), "left_anti")
    order = Window.partitionBy("tree").orderBy((F.col("sum") / F.col("steps")).desc(), F.col("steps").desc(), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    paths = settle(chosen.select("tree", F.col("node").alias("leaf"), "rank", "node"), "chat-paths")
    for level in reversed(levels[:-1]):
        up = level.where("up is not null").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "up")
        more = (paths.join(up, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")))
                .select("tree", "leaf", "rank", F.col("up").alias("node")))
        paths = settle(paths.unionByName(more).distinct(), "chat-paths")
    return paths


def format_paths(messages: DataFrame, branches: int = 1, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row per chosen path: tree, leaf, rank, formatted, loss (spans of code points: start, length).

    messages: tree, node, parent, role, text, score; node numbers grow from parent to reply. Null roles and
    texts are empty. Every span covers one whole escaped text.
    """
    paths = best_paths(messages, branches).withColumnsRenamed({"tree": "_t", "node": "_n"})
    turns = (paths.join(messages, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")))
             .groupBy("tree", "leaf", "rank")
             .agg(F.sort_array(F.collect_list(F.struct("node", "role", "text"))).alias("turns")))
    head = lambda x: F.concat(F.lit(OPEN), F.replace(escape(x["role"]), F.lit("\n"), F.lit("<n")), F.lit("\n"))
    parts = once(turns, parts=F.transform("turns", lambda x: F.struct(
        head(x).alias("head"), escape(x["text"]).alias("body"), F.coalesce(x["role"].isin(*trained), F.lit(False)).alias("trained"))))
    end = F.lit(len(CLOSE))

    def spans(p):
        sizes = F.transform(p, lambda x: F.struct(F.length(x["head"]).alias("h"), F.length(x["body"]).alias("b"), x["trained"].alias("t")))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
        return F.aggregate(sizes, zero, lambda a, x: F.struct(
            (a["at"] + x["h"] + x["b"] + end).alias("at"),
            F.when(x["t"], F.concat(a["spans"], F.array(F.struct((a["at"] + x["h"]).alias("start"), x["b"].alias("length")))))
            .otherwise(a["spans"]).alias("spans")), lambda a: a["spans"])

    return once(parts, formatted=F.array_join(F.transform("parts", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), ""),
                loss=spans(F.col("parts"))).select("tree", "leaf", "rank", "formatted", "loss")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    return F.transform(F.filter(F.split(formatted, CLOSE), lambda x: x != ""), lambda x: let(
        F.instr(x, "\n"), lambda at: F.struct(
            unescape(F.replace(F.substring(x, len(OPEN) + 1, at - 1 - len(OPEN)), F.lit("<n"), F.lit("\n"))).alias("role"),
            unescape(F.substring(x, at + 1, F.length(x))).alias("text"))))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each row replies to the one before.

    Rows come in the order of turn, then role and text where turns repeat; a null turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return numbered.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                           "role", "text", F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Format every conversation and describe it from the formatted string."""
    done = format_paths(settle(chains(conversations), "chat-chains"))
    read = once(done, turns=read_back(F.col("formatted")), lost=loss_text(F.col("formatted"), F.col("loss")))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
