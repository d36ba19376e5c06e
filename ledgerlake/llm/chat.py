"""Chat formatting of reply trees.

Messages name their parent. Iterated self-joins double the distance that an ancestor table covers (1, 2, 4, ... replies
up), so a tree of depth d takes log2(d) joins; the same tables then list the path of every leaf up to its root, each
ancestor once. Branches are ranked by score and each chosen path becomes one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.storage import materialize

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(c: F.Column) -> F.Column:
    r"""Doubles backslashes and puts one between < and |, so that no marker can stand inside a text."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(c: F.Column) -> F.Column:
    r"""As escape(), and line feeds become \n: a role ends at its line."""
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s, flags=re.DOTALL)


def reply_paths(messages: DataFrame, tree: str = "tree", message: str = "message", parent: str = "parent") -> DataFrame:
    """Lists (tree, leaf, message, up) for every leaf: the messages from it (up = 0) to its root (largest up).

    A message whose parent is null or not in its tree is a root. Messages that hang on a cycle of parents have no root
    and no path. Rows with a null tree or message belong nowhere and are left out; of rows that repeat a message of a
    tree the one with the smallest parent counts. An empty table gives no rows.
    """
    nodes = messages.select(F.col(tree).alias("tree"), F.col(message).alias("node"), F.col(parent).alias("parent")).where("tree IS NOT NULL AND node IS NOT NULL").groupBy("tree", "node").agg(F.min("parent").alias("parent"))
    nodes = materialize(nodes, "reply_nodes")
    links = nodes.where("parent IS NOT NULL").select("tree", "node", F.col("parent").alias("anc")).join(nodes.select("tree", F.col("node").alias("anc")), ["tree", "anc"]).select("tree", "node", "anc")
    jumps, count = [materialize(links, "reply_jump")], None
    lost = None
    while (now := jumps[-1].count()) > 0:
        if now == count:  # only messages that never reach a root are left
            lost = jumps.pop().select("tree", "node")
            break
        count = now
        step = jumps[-1].select("tree", F.col("node").alias("anc"), F.col("anc").alias("next"))
        jumps.append(materialize(jumps[-1].join(step, ["tree", "anc"]).select("tree", "node", F.col("next").alias("anc")), "reply_jump"))
    leaves = nodes.select("tree", "node").join(links.select("tree", F.col("anc").alias("node")), ["tree", "node"], "left_anti")
    if lost is not None:
        leaves = leaves.join(lost, ["tree", "node"], "left_anti")
    # each step writes only the messages that its jump adds, so the plan grows by one scan a step
    parts = [materialize(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "reply_part")]
    for k in reversed(range(len(jumps))):
        paths = reduce(DataFrame.union, parts)
        further = paths.join(jumps[k], ["tree", "node"]).select("tree", "leaf", F.col("anc").alias("node"), (F.col("up") + 2**k).alias("up"))
        parts.append(materialize(further, "reply_part"))
    paths = reduce(DataFrame.union, parts)
    return paths.withColumnRenamed("node", "message")


def rank_branches(paths: DataFrame, scores: DataFrame) -> DataFrame:
    """(tree, leaf, score, rank): branches by the mean score of their messages, best first, ties to the smaller leaf.

    scores has (tree, message, score); a missing or null score counts as 0.
    """
    best = paths.join(scores.groupBy("tree", "message").agg(F.max("score").alias("score")), ["tree", "message"], "left").groupBy("tree", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("score"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))


def format_chats(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row (tree, leaf, formatted, loss) for each chosen branch of each tree.

    messages: tree, message, parent, role, text, score. formatted holds <|im_start|>role, a line feed, the text and
    <|im_end|> for each turn from the root on; loss lists the spans [start, end) in code points of the assistant texts
    as they stand there. Null roles and texts are empty. The best `branches` of each tree are taken.
    """
    kept = messages.where("tree IS NOT NULL AND message IS NOT NULL").groupBy("tree", "message").agg(F.min_by(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")), F.struct("parent", "role", "text")).alias("m"))
    paths = materialize(reply_paths(messages), "reply_paths")
    chosen = rank_branches(paths, messages.select("tree", "message", "score")).where(F.col("rank") <= branches)
    turns = paths.join(chosen.select("tree", "leaf"), ["tree", "leaf"], "left_semi").join(kept, ["tree", "message"])
    head = F.concat(F.lit(START), escape_role(F.col("m.role")), F.lit("\n"))
    turns = turns.select("tree", "leaf", "up", (F.col("m.role") == "assistant").alias("trained"), head.alias("head"), escape(F.col("m.text")).alias("body"))
    size = F.char_length("head") + F.char_length("body") + len(END)
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.char_length("head"))
    span = F.when(F.col("trained"), F.struct(F.col("at").alias("start"), (F.col("at") + F.char_length("body")).alias("end")))
    parts = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("k"), F.concat("head", "body", F.lit(END)).alias("part"), span.alias("span")))).alias("t"))
    return parts.select("tree", "leaf", F.array_join(F.col("t.part"), "").alias("formatted"), F.filter("t.span", lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted conversation."""
    out = []
    for turn in formatted.split(START)[1:]:
        role, _, text = turn.removesuffix(END).partition("\n")
        out.append((unescape(role), unescape(text)))
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for batch in batches:
        rows = []
        for tree, formatted, loss in zip(*(batch.column(i) for i in range(3))):
            formatted = formatted.as_py()
            turns = read_back(formatted)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            trained = "".join(unescape(formatted[s["start"] : s["end"]]) for s in loss.as_py())
            rows.append((tree.as_py(), len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest(), len(formatted)))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])], names) if rows else pa.RecordBatch.from_pylist([], pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]))))


def chat_digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of conversations as read back from format_chats()."""
    return chats.select("tree", "formatted", "loss").mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Turn-numbered conversations as reply trees without branches: each row answers the one before.

    Rows go by turn, null turns first; rows of the same turn by role and text. A longer text scores higher.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").alias("tree"), "turn", "role", "text").where("tree IS NOT NULL")
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    return rows.select("tree", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text", F.char_length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))
