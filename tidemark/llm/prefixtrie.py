"""The trie of all conversation prefixes, built by van Emde Boas recursion.

A sequence of turns is cut at half its depth.  The cut prefixes get names, the
sequences up to the cut form an upper trie, and what follows each name forms a
lower forest; both are cut again, all of one height in one step.  ``cuts`` does
this from the largest height down: a step groups the sequences of a height by
the name they start from and the content of their upper half, and the smallest
conversation of a group is the name of the prefix.  Sequences with the same
upper half go on in the upper trie as one.  So the number of steps is the
logarithm of the depth, and a prefix that many conversations share is cut up
once.

``subtree_totals`` then grafts totals upward.  A node of depth d was named by
the cut of the height given by the lowest bit of d, and its problem starts at
the node ``up`` at that depth without the bit.  First, from the smallest height
up, the total of each lower forest is grafted on the node it starts from; then,
from the largest height down, a node gets the totals of the nodes that lie at
the end of the problem below it.  Again a logarithm of steps, each a join and an
aggregation with as many rows as there are nodes.

All totals are sums over a subtree: with ``W`` the words from the root to a
node, ``sum (n_convs - 1) * words`` over the nodes of a subtree is the sum of
``W`` over the conversations that end in it, less ``n_convs * W`` of the node's
parent, less the words of its nodes.

Every step works on rows of bounded size, never on a whole conversation or a
group: turns are numbered by a prefix sum in two phases over sorted parts, so
even one conversation with most of the rows is spread out.

Defined results: turns are ordered by (turn, null first; role; text), null role
or text becomes empty, rows with a null id belong to no conversation, repeated
rows are turns of their own.  An empty table has no nodes.  Columns other than the four
named ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.mixing import word_count
from tidemark.session import materialize

#: Additive totals of a subtree: ends of conversations, their words, childless nodes, words of the nodes.
TOTALS = ("n_ends", "end_words", "n_leaves", "node_words")
#: Conversation numbers hashed as one text; a node's list is put together from such blocks.
BLOCK = 4096
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def numbered(turns: DataFrame) -> DataFrame:
    """``conv, pos`` (from 1), ``key`` (32 bytes standing for role and text), ``words`` of every turn.

    All turns are sorted into ranges that may cut a conversation, numbered
    within their range, and moved on by the turns of the same conversation in
    earlier ranges.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    given = turns.where("conv_id is not null").select(F.col("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    ranged = given.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id())
    sign = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    found = ranged.select("conv", "part", within.alias("within"), sign.alias("key"), word_count(F.col("text")).alias("words"))
    found = materialize(found, "trie-turns")
    parts = found.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("conv", "part", F.coalesce(before, F.lit(0)).alias("before"))
    return found.join(parts, ["conv", "part"]).select("conv", (F.col("before") + F.col("within")).alias("pos"), "key", "words")


def with_shared_start(turns: DataFrame, group: int, shared: int) -> DataFrame:
    """Numbered turns in which every conversation starts with turns of its group's leader.

    The leader of c is ``c - c % group``; the first h of its turns replace the
    first h of c, h being the crc32 of the decimal c modulo ``shared``.
    """
    conv = F.col("conv")
    h = F.crc32(conv.cast("string").cast("binary")) % shared
    own = turns.where(F.col("pos") > h).select("conv", F.col("pos").alias("at"), F.lit(1).alias("mine"), "key", "words")
    lead = turns.where((conv % group == 0) & (F.col("pos") < shared)).select(F.col("conv").alias("leader"), "pos", "key", "words")
    followers = turns.where("pos = 1").select("conv", (conv - conv % group).alias("leader"), h.alias("h"))
    taken = followers.join(lead, "leader").where("pos <= h").select("conv", F.col("pos").alias("at"), F.lit(0).alias("mine"), "key", "words")
    # A leader with fewer turns leaves a gap of at most ``shared`` numbers before a conversation's own turns.
    lost = followers.where("h > 0").join(
        taken.groupBy("conv").agg(F.max("at").alias("has")), "conv", "left"
    ).select("conv", (F.col("h") - F.coalesce("has", F.lit(0))).alias("gap")).where("gap > 0")
    moved = own.join(lost, "conv", "left").withColumn("at", F.col("at") - F.coalesce("gap", F.lit(0))).drop("gap")
    return taken.unionByName(moved).select("conv", F.col("at").cast("bigint").alias("pos"), "key", "words")


def conversation_totals(turns: DataFrame, everyone: DataFrame) -> DataFrame:
    """``conv, len, total``: turns and words of every conversation of ``everyone``, 0 without turns."""
    sums = turns.groupBy("conv").agg(F.count("*").alias("len"), F.sum("words").alias("total"))
    zero = F.lit(0).cast("bigint")
    return everyone.join(sums, "conv", "left").select("conv", F.coalesce("len", zero).alias("len"), F.coalesce("total", zero).alias("total"))


def running_words(turns: DataFrame) -> DataFrame:
    """``conv, pos, words, before``: words of a turn and of all turns before it, again in two phases."""
    stretch = F.col("pos").bitwiseAND(F.lit(-BLOCK).cast("bigint"))
    cut = turns.select("conv", "pos", "words", stretch.alias("stretch"))
    inner = Window.partitionBy("conv", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sums = cut.groupBy("conv", "stretch").agg(F.sum("words").alias("n"))
    sums = sums.select("conv", "stretch", F.coalesce(F.sum("n").over(outer), zero).alias("earlier"))
    inside = cut.withColumn("inside", F.coalesce(F.sum("words").over(inner), zero))
    return inside.join(sums, ["conv", "stretch"]).select("conv", "pos", "words", (F.col("earlier") + F.col("inside")).alias("before"))


def contents(turns: DataFrame, height: int) -> list[DataFrame]:
    """Content of every whole run of 1, 2, 4 .. ``height`` turns that starts at a multiple of its length.

    ``conv, start, key``; the key of a run is the digest of its halves.
    """
    now = turns.select("conv", (F.col("pos") - 1).alias("start"), "key")
    out = [now]
    length = 1
    while length < height:
        half = F.col("start").bitwiseAND(F.lit(length).cast("bigint")) == 0
        pairs = now.groupBy("conv", F.col("start").bitwiseAND(F.lit(-2 * length).cast("bigint")).alias("start")).agg(
            F.max(F.when(half, F.col("key"))).alias("a"), F.max(F.when(~half, F.col("key"))).alias("b")
        )
        whole = pairs.where("a is not null and b is not null")
        now = materialize(whole.select("conv", "start", F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("key")), "trie-contents")
        out.append(now)
        length *= 2
    return out


def cuts(turns: DataFrame, sizes: DataFrame, depth: int) -> list[DataFrame]:
    """The cuts of all heights, smallest height first.

    Entry i holds the cuts of height 2 ** (i + 1): ``conv, start, up, name, len,
    total``, a sequence ``conv`` of the problem that starts at depth ``start``
    in the node ``up``, and the name of its prefix at half the height.
    """
    levels = 1
    while 2**levels <= depth:
        levels += 1
    half = 2 ** (levels - 1)
    content = contents(turns, half)
    root = sizes.agg(F.min("conv")).scalar()
    now = sizes.where("len > 0").select("conv", F.lit(0).cast("bigint").alias("start"), root.alias("up"), "len", "total")
    out = []
    while half:
        cut_at = F.col("start") + half
        keyed = now.join(content.pop(), ["conv", "start"])
        # The smallest conversation by name and content; joined back, so that a common prefix is no task's own.
        names = keyed.groupBy("start", "up", "key").agg(F.min("conv").alias("name"))
        found = materialize(keyed.join(names, ["start", "up", "key"]).drop("key"), "trie-cuts")
        out.append(found)
        short = now.where(F.col("len") < cut_at)
        upper = found.where("conv = name").select(*now.columns)
        lower = found.where(F.col("len") > cut_at).select("conv", cut_at.alias("start"), F.col("name").alias("up"), "len", "total")
        now = short.unionByName(upper).unionByName(lower)
        half //= 2
        if half > 1:
            now = materialize(now, "trie-problems")
    return out[::-1]


def _sums(prefix: str = "") -> list[Column]:
    return [F.sum(prefix + c).alias(c) for c in TOTALS]


def _added(left: DataFrame, more: DataFrame, on: list[str]) -> DataFrame:
    """``left`` with the totals of ``more`` added to its own."""
    renamed = more.select(*on, *[F.col(c).alias(f"more_{c}") for c in TOTALS])
    both = left.join(renamed, on, "left")
    return both.select(
        *[c for c in left.columns if c not in TOTALS], *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in TOTALS]
    )


def nodes_of(cut: list[DataFrame], turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every node below the root, with its own share of the totals.

    ``conv, depth, up, up_depth, parent, n_children, before`` and TOTALS.
    """
    named, ends = [], []
    for i, c in enumerate(cut):
        at = (F.col("start") + 2**i).alias("depth")
        named.append(c.where("conv = name").select("conv", at, "up", F.col("start").alias("up_depth"), F.lit(i).alias("level")))
        ends.append(c.where(F.col("len") == F.col("start") + 2**i).select(F.col("name").alias("conv"), at, "total"))
    nodes = reduce(DataFrame.unionByName, named)
    # The parent of a node of odd depth is where its problem starts; an even one ends a problem of height 2, which was cut at its parent.
    parents = cut[0].select("conv", (F.col("start") + 2).alias("depth"), F.col("name").alias("cut_name"))
    nodes = nodes.join(parents, ["conv", "depth"], "left").withColumn("parent", F.when(F.col("level") == 0, F.col("up")).otherwise(F.col("cut_name")))
    nodes = materialize(nodes.drop("cut_name"), "trie-names")
    ended = reduce(DataFrame.unionByName, ends).groupBy("conv", "depth").agg(F.count("*").alias("n_ends"), F.sum("total").alias("end_words"))
    children = nodes.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    words = running_words(turns).withColumnRenamed("pos", "depth")
    zero = F.lit(0).cast("bigint")
    full = nodes.join(words, ["conv", "depth"]).join(ended, ["conv", "depth"], "left").join(children, ["conv", "depth"], "left")
    return materialize(
        full.select(
            "conv", "depth", "level", "up", "up_depth", "parent", "before",
            F.coalesce("n_children", zero).alias("n_children"),
            F.coalesce("n_ends", zero).alias("n_ends"),
            F.coalesce("end_words", zero).alias("end_words"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
            F.col("words").alias("node_words"),
        ),
        "trie-nodes",
    )


def subtree_totals(nodes: DataFrame, cut: list[DataFrame]) -> DataFrame:
    """``nodes`` with TOTALS summed over the whole subtree of each."""
    grafted: list[DataFrame] = []
    for i in range(len(cut)):
        own = nodes.where(F.col("level") == i)
        if grafted:
            ending = F.col("up_depth").bitwiseAND(F.lit(2 ** (i + 1) - 1).cast("bigint")) == 2**i
            rows = reduce(DataFrame.unionByName, (g.where(ending).select("up", "up_depth", *TOTALS) for g in grafted))
            forest = rows.groupBy(F.col("up").alias("conv"), F.col("up_depth").alias("depth")).agg(*_sums())
            own = _added(own, forest, ["conv", "depth"])
        grafted.append(materialize(own, "trie-grafted"))
    done: list[DataFrame] = []
    for i in reversed(range(len(cut))):
        own = grafted[i]
        if done:
            below = reduce(DataFrame.unionByName, (d.select("conv", "depth", *TOTALS) for d in done))
            ways = cut[i].select("conv", "start", "name", (F.col("start") + 2 ** (i + 1)).alias("depth"))
            rows = ways.join(below, ["conv", "depth"]).groupBy(F.col("name").alias("conv"), (F.col("start") + 2**i).alias("depth")).agg(*_sums())
            own = _added(own, rows, ["conv", "depth"])
        done.append(materialize(own, "trie-totals"))
    return reduce(DataFrame.unionByName, done)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per run of rows of the same node; blocks come in order."""
    node, state = None, None

    def row(done, digest):
        return pa.record_batch(
            [pa.array([d[i] for d in done], pa.int64()) for i in (0, 1)] + [pa.array(digest, pa.string())],
            names=["conv", "depth", "ends_sha256"],
        )

    for batch in batches:
        done, digest = [], []
        for conv, depth, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (conv, depth) != node:
                if node is not None:
                    done.append(node)
                    digest.append(state.hexdigest())
                node, state = (conv, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if done:
            yield row(done, digest)
    if node is not None:
        yield row([node], [state.hexdigest()])


def end_digests(ends: DataFrame) -> DataFrame:
    """``conv, depth, ends_sha256``: digest of the numbers of a node's conversations, ascending, joined by commas.

    ``ends`` has ``conv, depth, member``.  Members become blocks of text first;
    a digest is sequential by nature, so the blocks of one node go through one
    task as a stream.
    """
    blocks = ends.groupBy("conv", "depth", F.shiftright("member", BLOCK.bit_length() - 1).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("members")
    )
    ordered = blocks.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "block")
    return ordered.select("conv", "depth", "members").mapInArrow(_hashed, "conv bigint, depth bigint, ends_sha256 string")


def trie(turns: DataFrame, everyone: DataFrame) -> DataFrame:
    """All nodes of the trie of numbered ``turns`` (``conv, pos, key, words``) of the conversations ``everyone``.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``; the root has depth 0.
    """
    turns = materialize(turns, "trie-rebuilt")
    sizes = materialize(conversation_totals(turns, everyone), "trie-sizes")
    depth = sizes.agg(F.max("len")).first()[0]
    root = sizes.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("conv_id is not null")
    idle = sizes.where("len = 0").select(sizes.agg(F.min("conv")).scalar().alias("conv"), F.lit(0).cast("bigint").alias("depth"), F.col("conv").alias("member"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    if not depth:
        zero = F.lit(0).cast("bigint")
        nodes = root.select(
            "conv_id", zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", zero.alias("n_children"),
            (zero + 1).alias("n_leaves"), zero.alias("saved_tokens"),
        )
        ends = idle
    else:
        cut = cuts(turns, sizes, depth)
        totals = subtree_totals(nodes_of(cut, turns, sizes), cut)
        below = materialize(
            totals.select(
                F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n_ends").alias("n_convs"), "n_children", "n_leaves",
                (F.col("end_words") - F.col("n_ends") * F.col("before") - F.col("node_words")).alias("saved_tokens"),
            ),
            "trie-below",
        )
        first = below.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        top = root.unionByName(first, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in (*root.columns, *first.columns)])
        top = top.select(
            "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens",
        )
        nodes = top.unionByName(below.select(*columns))
        ends = idle
        for i, c in enumerate(cut):
            at = F.col("start") + 2**i
            ends = ends.unionByName(c.where(F.col("len") == at).select(F.col("name").alias("conv"), at.alias("depth"), F.col("conv").alias("member")))
    digests = end_digests(ends).withColumnRenamed("conv", "conv_id")
    return nodes.join(digests, ["conv_id", "depth"], "left").select(
        *columns, F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")
    )
