"""Prefix trie of conversations, built by van Emde Boas recursion.

A node of depth d stands for a sequence of d turns (role and text) with which
conversations begin; those are its members.

Names.  Sequences are cut at half their depth, the halves again, down to single
turns.  Blocks (the halves of halves, at fixed places) are named from the bottom up,
a block from its two halves: blocks of up to 2**ROW turns inside one row, wider ones
by a shuffle for each doubling, each half as large as the one before.  Then the cuts are
named from the top down: the prefix that ends at a cut is named from the coarser
cut before it and the block between them.  All upper tries and lower forests of one
width are named together, so there are as many steps as the depth has binary digits.
A name is 128 bits of the SHA-256 of its two parts, so equal names are equal
sequences without a shared dictionary.

Nodes are names with their members counted.  Inside the operator a node is then
(smallest member, depth), since a conversation has one node at each depth.

Totals.  A subtrie of height 2**k knows, for each of its nodes, the totals of that
node's descendants inside it.  Two heights are joined by grafting: the totals of each root
of a lower forest are added to its ancestors in the upper trie, found on the path of
the root's smallest member.  Each height is one join and one sum, over all
subtries at once; a path of length n gives at most n/2 sums a height.

Skew.  Rows of a conversation are numbered and cut into blocks by their places, so a
conversation of any length lies in many tasks; sums are combined before they are
shuffled; names with over HOT members or children are looked up by broadcast.
The ids of a node's ending members are digested as a sorted stream.

Defined results: a null role or text is empty; rows of equal or null turn are ordered
by role, the first 32 characters and the SHA-256 of role and text; repeated rows are
turns of their own.  A null conv_id is a conversation without digits: it has no donor
and keeps all its turns, counts as a member, is larger than any id and is left out of
``ends_sha256``.  c - c%100 is the multiple of 100 at or below c.  An empty table has
no node.  Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import with_position
from tidemark.functions.staging import stage
from tidemark.llm import sequences
from tidemark.llm.sequences import NULL_ID, decimal, given_id, joined_sha256, known_id, looked_up, name_of
from tidemark.llm.text import whole

#: Turns that a donor gives at most, and conversations that share a donor.
GIFT, SHARED = 5, 100
#: Blocks of up to 2**ROW turns lie in one row.
ROW = 4
#: Pieces of a path that are joined by their place have 2**PIECE turns at most.
PIECE = 10
_NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of an empty string


def _root() -> Column:
    return F.lit("root").cast("binary")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, at, said, size): turns numbered from 1 in each conversation, without their texts."""
    rows = conversations.select(
        known_id(F.col("conv_id")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        whole(F.col("role")).alias("role"),
        F.substring(whole(F.col("text")), 1, sequences.HEAD).alias("head"),
        sequences.said(whole(F.col("role")), whole(F.col("text"))).alias("said"),
        F.length(whole(F.col("text"))).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [*sequences.turn_order("turn", "role", F.col("head"), "said"), F.col("copy")]
    return with_position(rows, order, "at", ["conv"]).select("conv", "at", "said", "size")


def _own(conv: Column) -> Column:
    """Turns at the start of a conversation that its donor's take the place of."""
    return (F.crc32(decimal(conv).cast("binary")) % (GIFT + 1)).cast("long")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with their donors' first turns: (conv, depth, said, size) and (conv, n)."""
    conv = F.col("conv")
    lead = F.when(conv != NULL_ID, conv - F.pmod(conv, F.lit(SHARED)))
    first = F.array_sort(F.collect_list(F.struct("at", "said", "size")))
    gifts = rows.where((F.col("at") <= GIFT) & (lead == conv)).groupBy(conv.alias("donor")).agg(first.alias("gift"))
    convs = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumn("donor", lead)
    # At most SHARED conversations have one donor, and there is one of a null id.
    convs = convs.join(gifts, "donor", "left").withColumn("h", _own(conv))
    gift = F.when(F.col("gift").isNull(), F.array().cast(gifts.schema["gift"].dataType))
    gift = gift.otherwise(F.slice("gift", F.lit(1), F.col("h").cast("int")))
    convs = stage(convs.withColumn("gift", gift).withColumn("given", F.size("gift").cast("long")), "convs")
    given = convs.select("conv", F.explode("gift").alias("g")).select("conv", F.col("g.at").alias("depth"), "g.said", "g.size")
    # Where a donor has fewer turns, the conversation's own move up; by pieces, for long ones.
    pieces = F.sequence(F.lit(0).cast("long"), F.shiftright("own", PIECE))
    short = convs.where("given < h").select(
        "conv", (F.col("h") - F.col("given")).alias("up"), F.explode(pieces).alias("piece")
    )
    own = rows.where(F.col("at") > _own(conv)).withColumn("piece", F.shiftright("at", PIECE))
    own = own.join(short, ["conv", "piece"], "left")
    depth = F.col("at") - F.coalesce("up", F.lit(0))
    lengths = convs.select("conv", (F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return given.unionByName(own.select("conv", depth.alias("depth"), "said", "size")), lengths


def _halved(names: Column) -> Column:
    """Names of pairs of neighbouring blocks; an odd last one is left out."""
    pairs = F.transform(names, lambda x, i: F.when(i % 2 == 1, name_of(F.get(names, i - 1), x)))
    return F.filter(pairs, lambda x: x.isNotNull())


def _upper_cuts(blocks: DataFrame, last: int) -> DataFrame:
    """(conv, cut, name): prefixes of ``cut`` whole blocks, from blocks (conv, block, name) up to ``last``."""
    widths = [blocks]
    while (last + 1) >> len(widths):
        pair = F.array_sort(F.collect_list(F.struct("block", "name")))
        halves = widths[-1].groupBy("conv", F.shiftright("block", 1).alias("to")).agg(pair.alias("p"))
        joined = halves.where(F.size("p") == 2).select(
            "conv", F.col("to").alias("block"), name_of(F.col("p")[0]["name"], F.col("p")[1]["name"]).alias("name")
        )
        widths.append(stage(joined, "blocks"))
    cuts = None
    for k in reversed(range(len(widths))):
        even = widths[k].where(F.col("block") % 2 == 0)
        start = F.col("block") * F.lit(1 << k)
        end = (start + F.lit(1 << k)).alias("cut")
        if cuts is None:
            found = even.where("block = 0").select("conv", end, name_of(_root(), F.col("name")).alias("name"))
            cuts = stage(found, "cuts")
            continue
        before = cuts.select("conv", F.col("cut").alias("start"), F.col("name").alias("upper"))
        grown = even.withColumn("start", start).join(before, ["conv", "start"], "left")
        upper = F.when(F.col("start") == 0, _root()).otherwise(F.col("upper"))
        grown = grown.select("conv", end, name_of(upper, F.col("name")).alias("name"))
        cuts = stage(cuts.unionByName(grown), "cuts")
    return cuts


def paths(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, depth, name, parent, size) of every prefix; ``rows`` as from ``rebuilt``."""
    width = 1 << ROW
    block = F.shiftright(F.col("depth") - 1, ROW)
    held = F.array_sort(F.collect_list(F.struct("depth", "said", "size"))).alias("turns")
    held = rows.groupBy("conv", block.alias("block")).agg(held)
    for k in range(ROW + 1):
        held = held.withColumn(f"b{k}", _halved(F.col(f"b{k - 1}")) if k else F.col("turns.said"))
    held = stage(held, "held")
    full = held.where(F.size(f"b{ROW}") == 1).select("conv", "block", F.col(f"b{ROW}")[0].alias("name"))
    last = full.agg(F.max("block")).first()[0]
    if last is None:
        held = held.withColumns({"start": _root(), "end": F.lit(None).cast("binary")})
    else:
        cuts = _upper_cuts(full, last)
        starts = cuts.select("conv", F.col("cut").alias("block"), F.col("name").alias("start"))
        ends = cuts.select("conv", (F.col("cut") - 1).alias("block"), F.col("name").alias("end"))
        held = held.join(starts, ["conv", "block"], "left").join(ends, ["conv", "block"], "left")
        held = held.withColumn("start", F.when(F.col("block") == 0, _root()).otherwise(F.col("start")))
    blocks = F.array(*[F.col(f"b{k}") for k in range(ROW)])
    digits = F.array(*[F.lit(k) for k in reversed(range(ROW))])
    weights = F.array(*[F.lit(1 << k) for k in range(ROW)])

    def prefix(n: Column) -> Column:
        """From the coarsest cut at or before ``n`` down to ``n``."""

        def lower(upper: Column, k: Column) -> Column:
            at = F.floor(n / F.get(weights, k)).cast("int")
            return F.when(at % 2 == 1, name_of(upper, F.get(F.get(blocks, k), at - 1))).otherwise(upper)

        return F.when(n == width, F.col("end")).otherwise(F.aggregate(digits, F.col("start"), lower))

    names = F.transform("turns", lambda t, i: prefix(i + 1))
    cut = held.select("conv", "start", "turns", names.alias("names"))
    placed = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["depth"].alias("depth"),
            F.get("names", i).alias("name"),
            F.when(i == 0, F.col("start")).otherwise(F.get("names", i - 1)).alias("parent"),
            t["size"].alias("size"),
        ),
    )
    below = cut.select("conv", F.explode(placed).alias("t")).select("conv", "t.*")
    zero = F.lit(0).cast("long")
    top = lengths.select(
        "conv", zero.alias("depth"), _root().alias("name"), F.lit(None).cast("binary").alias("parent"), zero.alias("size")
    )
    return top.unionByName(below)


def _grafted(totals: DataFrame, owners: DataFrame, deepest: int) -> DataFrame:
    """Sums over subtrees of (rep, depth, leaves, saved); ``owners`` gives (conv, depth) its node's rep."""
    k = 0
    while 1 << k <= deepest:
        step, shift = 1 << k, min(k, PIECE)
        at = F.col("depth")
        roots = totals.where(at.bitwiseAND(F.lit(2 * step - 1)) == step)
        pieces = F.sequence(F.shiftright(at - step, shift), F.shiftright(at, shift) - 1)
        roots = roots.select(F.col("rep").alias("conv"), F.explode(pieces).alias("piece"), "leaves", "saved")
        above = owners.withColumn("piece", F.shiftright("depth", shift)).join(roots, ["conv", "piece"])
        both = totals.unionByName(above.select("rep", "depth", "leaves", "saved"))
        totals = both.groupBy("rep", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        totals = stage(totals, "totals")
        k += 1
    return totals


def _endings(members: DataFrame) -> DataFrame:
    """(name, ends_sha256) from (name, conv) of the conversations that end there."""
    known = members.where(F.col("conv") != NULL_ID)
    sizes = known.groupBy("name").agg(F.count(F.lit(1)).alias("k"), F.min("conv").alias("one"))
    sizes = stage(sizes, "endings")
    alone = sizes.where("k = 1").select("name", F.sha2(F.col("one").cast("string"), 256).alias("ends_sha256"))
    several = looked_up(known, sizes.where("k > 1"), ["name"], "k").withColumn("line", F.col("conv").cast("string"))
    listed = joined_sha256(several, "name", ["conv"], "line", ",")
    return alone.unionByName(listed.withColumnRenamed("sha256", "ends_sha256"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations."""
    rows, lengths = rebuilt(stage(turns(conversations), "turns"))
    every = stage(paths(rows, lengths), "paths")
    same = [F.min(c).alias(c) for c in ("depth", "parent", "size")]
    found = every.groupBy("name").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), *same)
    found = stage(found, "nodes")
    children = found.where("parent is not null").groupBy(F.col("parent").alias("name"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = found.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stage(nodes, "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0

    owners = looked_up(every.select("name", "conv"), nodes.select("name", "rep", "depth", "n_convs"), ["name"], "n_convs")
    owners = stage(owners.select("conv", "depth", "rep"), "owners")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    weights = nodes.select("rep", "depth", leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    totals = _grafted(weights.where("leaves > 0 or saved > 0"), owners, deepest)

    parents = nodes.select(F.col("name").alias("parent"), F.col("rep").alias("parent_rep"), "n_children")
    lower = looked_up(
        nodes.where("depth > 0").drop("n_children"), parents.where("n_children > 0"), ["parent"], "n_children"
    ).select("name", "parent_rep")
    ends = every.join(lengths.withColumnRenamed("n", "depth"), ["conv", "depth"]).select("name", "conv")
    full = nodes.join(lower, "name", "left").join(_endings(ends), "name", "left").join(totals, ["rep", "depth"], "left")
    return full.select(
        given_id(F.col("rep")).alias("conv_id"),
        "depth",
        given_id(F.col("parent_rep")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.coalesce("leaves", F.lit(0)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )
