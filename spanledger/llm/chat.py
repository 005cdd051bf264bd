"""Chat formatting: reply trees to root-to-leaf paths, the best branches as formatted conversations.

Messages are nodes (conv_id, node, parent, role, text, score). Iterative self-joins enumerate the paths by doubling: after
k rounds every node knows its 2^k-th ancestor and the sum of the scores up to there, so a path of d messages takes log2(d)
rounds, and only ids and numbers move. Leaves are ranked per conversation by the mean score of their path; the paths of the
chosen leaves are then collected by the same ancestor tables in reverse order. The texts are joined once, at the end.

A path is one conversation and therefore one row. Its text is as long as the path; nothing else is gathered.

Template: <|im_start|>role\\ntext<|im_end|>\\n for each turn. In roles and texts a backslash becomes two and "<|" becomes "<\\|",
in roles a line feed becomes "\\n", so that marks in texts are no marks and every turn can be read back.

A null text or role is empty, a null conv_id is a conversation of its own. A parent that doesn't exist makes its child a root;
messages on a ring of parents have no root and are left out. Of messages under one (conv_id, node) the smallest by (parent,
role, text, score), null first, is taken whole. Ties of score go to the smaller leaf. A very long text is one row's work. An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm.common import written

START, END = "<|im_start|>", "<|im_end|>\n"
_TURN = "struct<role:string,text:string>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescaped(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """Every second piece of a split at double backslashes is one backslash; the pieces hold single ones only."""
    def plain(piece: Column) -> Column:
        return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, piece)

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def unescape(text: Column) -> Column:
    return _unescaped(text, (("<\\|", "<|"),))


def unescape_role(role: Column) -> Column:
    return _unescaped(role, (("<\\|", "<|"), ("\\n", "\n")))


def linear(conversations: DataFrame) -> DataFrame:
    """Rows by turn as the simplest tree: each message answers the one before; equal turns are ordered by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"),
    )


def _same(a: str, a_node: str, b: str, b_node: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.{a_node}") == F.col(f"{b}.{b_node}"))


def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of (conv_id, node, anc) for the 1st, 2nd, 4th ... ancestor, and (conv_id, node, depth, total) of finished nodes.

    Every round writes one table of all nodes. A node whose ancestor has finished ends with the ancestor's sums.
    """
    ids = nodes.select("conv_id", "node")
    step = (
        nodes.alias("a").join(ids.alias("b"), _same("a", "parent", "b", "node"), "left")
        .select("a.conv_id", "a.node", F.col("b.node").alias("anc"), F.lit(1).cast("long").alias("depth"), F.col("a.score").alias("total"))
    )
    jumps, limit, most = [], 1, None
    while True:
        step = written(step, "jumps")
        finished, going = step.filter(F.col("anc").isNull()), step.filter(F.col("anc").isNotNull())
        if going.isEmpty():
            break
        if most is None:
            most = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0]
        if limit > most:  # only rings of parents are left
            break
        limit *= 2
        jumps.append(going.select("conv_id", "node", "anc"))
        further = (
            going.alias("a").join(step.alias("b"), _same("a", "anc", "b", "node"))
            .select(
                "a.conv_id", "a.node", "b.anc", (F.col("a.depth") + F.col("b.depth")).alias("depth"),
                (F.col("a.total") + F.col("b.total")).alias("total"),
            )
        )
        step = finished.unionByName(further)
    return jumps, finished.select("conv_id", "node", "depth", "total")


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(conv_id, leaf, depth, role, text) of the best root-to-leaf paths of every conversation."""
    nodes = messages.select(
        "conv_id", F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"), "role", "text",
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    nodes = written(nodes, "messages")
    unique = nodes.groupBy("conv_id", "node").agg(
        F.min(F.struct("parent", "role", "text", "score")).alias("m")
    ).select("conv_id", "node", "m.*")
    ids = unique.select("conv_id", "node", "parent", "score")
    jumps, ends = _ancestors(ids)
    answered = ids.select("conv_id", F.col("parent").alias("node")).filter(F.col("node").isNotNull()).distinct()
    leaves = ends.alias("a").join(answered.alias("b"), _same("a", "node", "b", "node"), "left_anti")
    rank = Window.partitionBy("conv_id").orderBy(F.desc(F.col("total") / F.col("depth")), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= best)
    on_path = chosen.select("conv_id", F.col("node").alias("leaf"), "node")
    for jump in reversed(jumps):
        up = on_path.alias("a").join(jump.alias("b"), _same("a", "node", "b", "node"))
        on_path = written(on_path.unionByName(up.select("a.conv_id", "a.leaf", F.col("b.anc").alias("node"))), "paths")
    with_depth = on_path.alias("a").join(ends.alias("b"), _same("a", "node", "b", "node")).select("a.*", "b.depth")
    return (
        with_depth.alias("a").join(unique.alias("b"), _same("a", "node", "b", "node"))
        .select("a.conv_id", "a.leaf", "a.depth", "b.role", "b.text")
    )


def format_paths(rows: DataFrame) -> DataFrame:
    """One conversation per path: formatted, and segments (text, loss) whose texts joined are formatted.

    loss marks what a model is trained on: the escaped texts of the assistant.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("depth", escape_role(role).alias("role"), escape(text).alias("text"), (role == "assistant").alias("loss"))
    grouped = rows.groupBy("conv_id", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(F.concat(F.lit(START), t.role, F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(t.text.alias("text"), t.loss.alias("loss")),
                F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    out = grouped.select("conv_id", "leaf", segments.alias("segments"))
    return out.select("*", F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> out of a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(part: Column) -> Column:
        body = F.substr(part, F.lit(len(START) + 1))
        cut = F.instr(body, "\n")
        return F.struct(
            unescape_role(F.substr(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substr(body, cut + 1)).alias("text")
        )

    return F.transform(F.filter(parts, lambda p: p != ""), turn)


def format_conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, leaf, segments, formatted of the best paths."""
    return format_paths(paths(messages, best))


def digests(formatted: DataFrame) -> DataFrame:
    """Sizes and digests read back from formatted conversations."""
    turns = read_turns(F.col("formatted"))
    said = F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescape(s.text))
    read = formatted.select("conv_id", turns.alias("turns"), F.array_join(said, "").alias("loss"), "formatted")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
