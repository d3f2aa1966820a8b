r"""Chat formatting: reply trees become conversations, one text with a loss mask for each chosen path.

1. Branches. The replies to one message (and the roots of one tree) are ranked by score, best
   first (null scores last, ties: the smaller message_id). A path is as good as its sequence of
   ranks from the root on, compared place by place. Where only ``keep`` paths of a tree are
   wanted, a branch ranked behind ``keep`` cannot be on one of them and goes before anything is joined.
2. Paths. Self-joins double a table of ancestors: from the parents come the grandparents, from
   these the ancestors at distance four, and so on, so a chain of n messages takes log2(n) rounds.
   The same tables then lengthen the paths upwards from every leaf. Every round is written, so
   a lost executor costs one round. Only ids travel here.
3. Format. The texts join their places, running lengths give the spans of the loss mask, and each path
   becomes one text. A turn is ``### <role>:``, a line feed, the body, a line feed, ``</turn>``, a line feed.

Control strings in roles and texts are written as a backslash and a letter: ``\b`` for a backslash,
``\e`` for ``</turn>``, ``\h`` for ``###``, and in roles ``\n`` for a line feed. So a backslash in the
output always begins such a pair, no text can end a turn or begin one, and ``unescape`` is exact.

Defined cases: a null role or text is empty; a message whose parent is null or not in its tree is a
root; rows that repeat a message_id are all formatted, in the message's place, ordered by role and text,
and of their parents and scores the one with the best score counts (ties: the smallest parent); a
message without an id is on no path, nor is one whose parents go round in a circle; a null tree_id is
a tree of its own; an empty table has no paths; other columns are not looked at. A conversation is one value, so
its text has to fit into one (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import only, stored

# Fixed values of the template.
HEAD, HEAD_END, TURN_END = "### ", ":\n", "\n</turn>\n"
CODES = [("\\", "\\b"), ("</turn>", "\\e"), ("###", "\\h")]
ROLE_CODES = [*CODES, ("\n", "\\n")]


def escape(text: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain, code in codes:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescape(text: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def read_turns(text: Column) -> Column:
    """The turns of a formatted text again: an array of (role, text)."""
    parts = F.split(text, TURN_END, -1)
    return F.transform(
        F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda t: F.struct(
            unescape(F.substr(t, F.lit(len(HEAD) + 1), F.instr(t, HEAD_END) - F.lit(len(HEAD) + 1)), ROLE_CODES).alias("role"),
            unescape(F.substr(t, F.instr(t, HEAD_END) + F.lit(len(HEAD_END)))).alias("text"),
        ),
    )


def read_loss(text: Column, loss: Column) -> Column:
    """Everything under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(text, s["start"] + F.lit(1), s["end"] - s["start"]))), ""
    )


def chain_links(conversations: DataFrame) -> DataFrame:
    """Turns in order as a reply chain: (tree_id, message_id, parent_id, score); rows of one turn share its place."""
    order = Window.partitionBy("tree_id").orderBy(F.col("turn").asc_nulls_first())
    turns = conversations.select(F.col("conv_id").alias("tree_id"), "turn").distinct()
    return turns.select(
        "tree_id",
        turn_id(F.col("turn")).alias("message_id"),
        F.lag(turn_id(F.col("turn"))).over(order).alias("parent_id"),
        F.lit(None).cast("double").alias("score"),
    )


def turn_id(turn: Column) -> Column:
    return F.coalesce(turn.cast("string"), F.lit(""))


def _same(a: str, b: str, left: str, right: str) -> Column:
    """Tree of ``a`` and ``b`` the same (null too), and the columns ``left`` and ``right`` equal."""
    return F.col(f"{a}.tree_id").eqNullSafe(F.col(f"{b}.tree_id")) & (F.col(f"{a}.{left}") == F.col(f"{b}.{right}"))


def _branches(links: DataFrame, keep: int | None) -> DataFrame:
    """One row per message: parent_id (null: a root) and its rank among its siblings, up to ``keep``."""
    nodes = (
        only(links, "tree_id", "message_id", "parent_id", "score").filter("message_id IS NOT NULL")
        .groupBy("tree_id", "message_id", "parent_id").agg(F.max("score").alias("score"))
        .withColumn("parent", F.struct(F.col("score").isNull(), -F.col("score"), F.col("parent_id")))
        .groupBy("tree_id", "message_id").agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
        .select("tree_id", "message_id", F.col("parent.parent_id").alias("parent_id"), "score")
    )
    nodes = stored(nodes, "chat-nodes")
    known = nodes.select("tree_id", F.col("message_id").alias("known"))
    rooted = (
        nodes.alias("n").join(known.alias("k"), _same("n", "k", "parent_id", "known"), "left")
        .select("n.tree_id", "n.message_id", F.col("known").alias("parent_id"), "n.score")
    )
    siblings = Window.partitionBy("tree_id", "parent_id").orderBy(F.col("score").desc_nulls_last(), "message_id")
    ranked = rooted.withColumn("branch", F.row_number().over(siblings)).drop("score")
    return ranked if keep is None else ranked.filter(F.col("branch") <= keep)


def best_paths(links: DataFrame, keep: int | None = 1) -> DataFrame:
    """``links`` (tree_id, message_id, parent_id, score): the ``keep`` best root-to-leaf paths of every tree (None: all).

    One row per path and message: tree_id, path_id (the leaf's message_id), path_rank (from 1; ``keep``
    None: from 1 too), message_id, place (from 1 at the root).
    """
    nodes = stored(_branches(links, keep), "chat-branches")
    size = nodes.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0
    ups = [stored(nodes.filter("parent_id IS NOT NULL").select("tree_id", "message_id", F.col("parent_id").alias("up")), "chat-up")]
    while 2 ** (len(ups) - 1) <= size and not ups[-1].isEmpty():
        a, b = ups[-1].alias("a"), ups[-1].alias("b")
        ups.append(stored(a.join(b, _same("a", "b", "up", "message_id")).select("a.tree_id", "a.message_id", "b.up"), "chat-up"))
    # Whoever has an ancestor farther off than its tree has messages goes round in a circle.
    circling = ups.pop()
    parents = nodes.filter("parent_id IS NOT NULL").select("tree_id", F.col("parent_id").alias("message_id")).distinct()
    leaves = nodes.alias("n").join(parents.alias("p"), _same("n", "p", "message_id", "message_id"), "left_anti")
    leaves = leaves.alias("n").join(circling.alias("p"), _same("n", "p", "message_id", "message_id"), "left_anti")
    paths = stored(
        leaves.select("tree_id", F.col("message_id").alias("path_id"), "message_id", F.lit(0).cast("long").alias("above")), "chat-paths"
    )
    for k, up in enumerate(ups):
        more = (
            paths.alias("p").join(up.alias("u"), _same("p", "u", "message_id", "message_id"))
            .select("p.tree_id", "p.path_id", F.col("u.up").alias("message_id"), (F.col("above") + 2**k).alias("above"))
        )
        paths = stored(paths.unionByName(more), "chat-paths")
    by_path = Window.partitionBy("tree_id", "path_id")
    placed = paths.withColumn("place", F.max("above").over(by_path) - F.col("above") + 1).drop("above")
    order = (
        placed.alias("p").join(nodes.alias("n"), _same("p", "n", "message_id", "message_id"))
        .groupBy("p.tree_id", "path_id")
        .agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "branch"))), lambda x: x["branch"]).alias("branches"),
            # Below a branch that went, paths end at the gap instead of at a root.
            F.bool_or((F.col("place") == 1) & F.col("parent_id").isNull()).alias("rooted"),
        )
        .filter("rooted")
        .withColumn("path_rank", F.row_number().over(Window.partitionBy("tree_id").orderBy("branches")))
        .select("tree_id", "path_id", "path_rank")
    )
    if keep is not None:
        order = order.filter(F.col("path_rank") <= keep)
    return placed.alias("p").join(order.alias("o"), _same("p", "o", "path_id", "path_id")).select(
        "p.tree_id", "p.path_id", "path_rank", "message_id", "place"
    )


def format_paths(paths: DataFrame, messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """``paths`` with the (tree_id, message_id, role, text) of ``messages``: one row (tree_id, path_id, path_rank, text, loss) a path.

    ``loss`` holds the spans (start, end), in characters of ``text``, of the bodies whose role is ``learned``.
    """
    rows = (
        only(messages, "tree_id", "message_id", "role", "text").alias("m")
        .join(only(paths, "tree_id", "path_id", "path_rank", "message_id", "place").alias("p"),
              _same("m", "p", "message_id", "message_id"))
        .select("p.tree_id", "path_id", "path_rank", "place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("head", F.concat(F.lit(HEAD), escape(F.col("role"), ROLE_CODES), F.lit(HEAD_END)))
        .withColumn("body", escape(F.col("text")))
    )
    order = Window.partitionBy("tree_id", "path_id", "path_rank").orderBy("place", "role", "text")
    length = F.length("head") + F.length("body") + F.lit(len(TURN_END))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("after") - F.lit(len(TURN_END))
    turn = F.struct(
        "number", F.concat("head", "body", F.lit(TURN_END)).alias("turn"), (F.col("role") == learned).alias("learned"),
        (end - F.length("body")).cast("int").alias("start"), end.cast("int").alias("end"),
    )
    turns = F.col("turns")
    return (
        rows.withColumn("after", F.sum(length).over(so_far)).withColumn("number", F.row_number().over(order))
        .groupBy("tree_id", "path_id", "path_rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select(
            "tree_id", "path_id", "path_rank",
            F.array_join(F.transform(turns, lambda t: t["turn"]), "").alias("text"),
            F.transform(F.filter(turns, lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss"),
        )
    )


def format_trees(messages: DataFrame, keep: int | None = 1, learned: str = "assistant") -> DataFrame:
    """``messages`` (tree_id, message_id, parent_id, role, text, score): the ``keep`` best paths of every tree as conversations."""
    return format_paths(best_paths(messages, keep), messages, learned)


def format_conversations(conversations: DataFrame, learned: str = "assistant") -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) as trees of one path: (conv_id, text, loss).

    Turns go in order, null first; rows of one turn by role and text.
    """
    base = only(conversations, "conv_id", "turn", "role", "text")
    messages = base.select(F.col("conv_id").alias("tree_id"), turn_id(F.col("turn")).alias("message_id"), "role", "text")
    return format_paths(best_paths(chain_links(base)), messages, learned).select(F.col("tree_id").alias("conv_id"), "text", "loss")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader finds in (conv_id, text, loss): number and hash of the turns, length and hash of the text under the mask."""
    turns, masked = F.col("turns"), F.col("masked")
    return (
        formatted.withColumn("turns", read_turns(F.col("text")))
        .withColumn("masked", read_loss(F.col("text"), F.col("loss")))
        .select(
            "conv_id",
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
            .alias("turns_sha256"),
            F.length(masked).cast("long").alias("loss_chars"),
            F.sha2(masked, 256).alias("loss_sha256"),
            F.length("text").cast("long").alias("formatted_chars"),
        )
    )
