"""Chat formatting of reply trees.

Messages form trees: each names the message that it replies to.  Iterated
self-joins double the known stretch of every message's way to its root: after
round k a message knows its 2**k-th ancestor and the score of the messages in
between.  The leaves are then ranked within their tree by the score of their
branch, and the chosen branches are unfolded with the same tables, from the
longest jump to the shortest, so that a row for each message on the way comes
out once.  Every chosen branch becomes one formatted conversation.  A depth d
takes about log2(d) joins.  All of it is DataFrame expressions.

A turn is ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a
line break.  Inside roles and texts, ``%`` becomes ``%25`` and ``<|`` becomes
``%3C|``, so no text can look like a mark; ``unescaped`` undoes it.  The loss
mask lists the stretches, in bytes of the formatted text, that hold texts of
assistants.

Defined results: null texts and roles count as empty; a null conversation key
is a key of its own; of messages with equal turn the smaller (role, text) comes
first, repeated rows come one after the other; a message whose parent is
missing is a root; a cycle of replies has no leaf and no root and is left out;
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

#: The marks of a turn.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escaped(text):
    """The text without the opening of a mark."""
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescaped(text):
    return F.replace(F.replace(text, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def escaped_role(role):
    """A role also keeps to one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("%0A"))


def unescaped_role(role):
    return F.replace(F.replace(F.replace(role, F.lit("%3C|"), F.lit("<|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def from_turns(table: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of a table by turn: each replies to the one before it, and scores 1."""
    order = Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "role", "text")
    plain = table.select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    numbered = plain.withColumn("node", F.row_number().over(order).cast("bigint"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("key", "node", parent.alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def _ways_up(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables ``key, node, up, gain``: the ancestor 1, 2, 4 ... steps up (null beyond the root), and the score from the node to below it.

    A node whose way has reached the root is done, and later tables leave it
    out.  The second result holds the done nodes, whose gain is the score of the
    whole way; replies in a circle are never done.
    """
    here = messages.select("key", "node", "parent", "score")
    known = here.select(F.col("key").alias("k"), F.col("node").alias("up"))
    linked = here.join(known, F.col("key").eqNullSafe(F.col("k")) & (F.col("parent") == F.col("up")), "left")
    tables = [materialize(linked.select("key", "node", "up", F.col("score").alias("gain")), "chat-up0")]
    done = tables[0].where("up is null")
    rounds = messages.count().bit_length()  # more than the longest way needs
    while len(tables) <= rounds and not (going := tables[-1].where("up is not null")).isEmpty():
        state = done.unionByName(going)
        further = state.select(F.col("key").alias("k"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("gain").alias("gain2"))
        same = F.col("key").eqNullSafe(F.col("k")) & (F.col("up") == F.col("n"))
        doubled = going.join(further, same).select(
            "key", "node", F.col("up2").alias("up"), (F.col("gain") + F.col("gain2")).alias("gain")
        )
        tables.append(materialize(doubled, f"chat-up{len(tables)}"))
        done = done.unionByName(tables[-1].where("up is null"))
    return tables, done


def branches(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """``key, leaf, place, role, text`` of the ``per_tree`` best branches of each key; places count from the root, 0 first.

    ``messages``: key, node, parent, score, role, text; a node is unique in its key.
    """
    messages = materialize(messages, "chat-messages")
    tables, total = _ways_up(messages)
    parents = tables[0].where("up is not null").select(F.col("key").alias("k"), F.col("up").alias("n")).distinct()
    leaf = F.col("key").eqNullSafe(F.col("k")) & (F.col("node") == F.col("n"))
    ends = total.join(parents, leaf, "left_anti")
    best = Window.partitionBy("key").orderBy(F.desc("gain"), "node")
    chosen = ends.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= per_tree)
    rows = chosen.select("key", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("steps"))
    for k in range(len(tables) - 1, -1, -1):
        jump = tables[k].where("up is not null").select(F.col("key").alias("k"), F.col("node").alias("n"), "up")
        same = F.col("key").eqNullSafe(F.col("k")) & (F.col("node") == F.col("n"))
        jumped = rows.join(jump, same).select("key", "leaf", F.col("up").alias("node"), (F.col("steps") + 2**k).alias("steps"))
        rows = materialize(rows.unionAll(jumped), f"chat-way{k}")
    said = messages.select(F.col("key").alias("k"), F.col("node").alias("n"), "role", "text")
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("node") == F.col("n"))
    return rows.join(said, same).select("key", "leaf", (-F.col("steps")).alias("place"), "role", "text")


def formatted(turns: DataFrame) -> DataFrame:
    """``key, leaf, formatted, loss_mask`` of the branches: one text, and the stretches of it to learn from."""
    head = F.concat(F.lit(START), escaped_role("role"), F.lit("\n"))
    body = escaped("text")
    piece = F.concat("head", "body", F.lit(END + "\n"))
    so_far = Window.partitionBy("key", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.octet_length("piece").cast("bigint")).over(so_far), F.lit(0))
    laid = (
        turns.withColumn("head", head)
        .withColumn("body", body)
        .select("key", "leaf", "place", "role", piece.alias("piece"), F.octet_length("head").alias("before"), F.octet_length("body").alias("size"))
        .withColumn("start", begin + F.col("before"))
    )
    turn = F.struct("place", "piece", (F.col("role") == ASSISTANT).alias("learn"), "start", F.col("size").cast("bigint").alias("size"))
    listed = laid.groupBy("key", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return listed.select(
        "key",
        "leaf",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["size"].alias("size"))
        ).alias("loss_mask"),
    )


def parsed(text):
    """The turns of a formatted text, as an array of role and text."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")

    def turn(part):
        inner = F.substr(part, F.lit(len(START) + 1))
        role = F.substring_index(inner, "\n", 1)
        return F.struct(
            unescaped_role(role).alias("role"), unescaped(F.substr(inner, F.char_length(role) + 2)).alias("text")
        )

    return F.transform(parts, turn)


def masked_text(text, mask):
    """The texts under the loss mask, put together; cut from the bytes, which takes no search."""
    whole = text.cast("binary")
    return F.array_join(F.transform(mask, lambda m: unescaped(F.substring(whole, (m["start"] + 1).cast("int"), m["size"].cast("int")).cast("string"))), "")


def digests(conversations: DataFrame) -> DataFrame:
    """Counts and digests of conversations, read back from the formatted text."""
    read = conversations.withColumn("turns", parsed(F.col("formatted"))).withColumn(
        "loss", masked_text(F.col("formatted"), F.col("loss_mask"))
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("key").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
