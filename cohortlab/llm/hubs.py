"""From buckets of candidates to components of verified links, without
expanding buckets into pairs.

Each bucket picks a hub, and every member is verified against it on the whole
sets; linked members join the hub's component.  What may still link lies in
buckets that hold several components, and there only in pairs with a member x
that does not link with the hub.  Such a pair must share tokens of their
differences from the hub, as |x - hub| + |y - hub| exceeds what the two may
differ in.  Those tokens, rarest first and only as many as the bound asks for,
are the next buckets.  When they are small, or after ``rounds`` of this, the
remaining pairs across components are all verified.  A caller with a finer
signature may split such buckets by it before any tokens are written.  Buckets of few
members need no hub: their pairs are verified at the end, where components
still differ.  No pair that shares a bucket and links is lost: it ends in one
component.

Links inside a component are then counted exactly by :func:`link_counts`: its
members, in order of size, are cut into blocks of bounded length, and every two
blocks whose sizes allow a link are compared as matrices in one row of a task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import components, range_ranked
from cohortlab.plans.guards import materialize

FEW = 6       # at most 2.5 pairs per member
MEMBERS = 128             # of a block
BLOCK_TOKENS = 1 << 15    # of a block of several members, about
WIDTH = 4096              # tokens that are compared at a time


def link_components(buckets: DataFrame, sets: DataFrame, num: int, den: int, rounds: int = 3, small: int = 1000,
                    expand: Callable[[Column], Column] = lambda c: c, few: int = FEW, strays: bool = False,
                    compare: Callable[[DataFrame], DataFrame] | None = None,
                    finer: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``buckets``: ``bucket, node``; ``sets``: ``node, n, body`` with one row
    per node, where ``expand(body)`` is the array of the set's ``n`` tokens.
    Sets link when ``den * intersection >= num * union``.

    With ``strays`` the hub is a member of its bucket, and where at most
    ``few`` members do not link with it, these are compared with the whole
    bucket, ``few`` pairs a member at most, in place of further buckets.  After
    the first buckets, whose members meet by chance too, so are up to
    ``few * few`` members, and all in buckets of at most ``small``.
    ``compare`` turns ``a, b, x, y, nx, ny`` (pairs and their bodies) into
    ``a, b, link``, where the bodies need not be expanded for that.

    ``finer`` gives new buckets for the members (``node, body``) of those first
    buckets that still hold several components, most of whose pairs are far
    from linking; tokens then serve only where these buckets stay open too.

    Returns ``node, component`` for all nodes of ``buckets``.
    """
    score = materialize(buckets.groupBy("node").agg(F.count("*").alias("score")), "link-scores")
    part = score.select("node", F.col("node").alias("component"))
    links, final = None, False
    tiny, sizes = None, sets.select("node", "n")

    def join_up(pairs):
        nonlocal links
        found = materialize(_verify(pairs, sets, num, den, expand, compare), "link-verified")
        new = found.where("link").select("a", "b")
        links = new if links is None else links.unionByName(new)
        part = score.select("node").join(components(links), "node", "left").select(
            "node", F.coalesce("component", "node").alias("component"))
        return found, materialize(part, "link-components")

    last = rounds + (finer is not None)
    for turn in range(last + 1):
        if final:
            _, part = join_up(_pairs_left(buckets, num, den))
            break
        hubs = materialize(_hubs(buckets.select("bucket", "node"), score, strays), "link-hubs")
        placed = buckets.select("bucket", "node").join(hubs, "bucket")
        now = placed.where(F.col("size") <= few).select("bucket", "node", F.lit(True).alias("lead"))
        tiny = now if tiny is None else tiny.unionByName(now)
        member = placed.where((F.col("size") > few) & (F.col("node") != F.col("hub")))
        pairs = member.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        found, part = join_up(pairs)
        if strays:
            # a bucket all of whose members link with its hub is one component, and done
            apart = found.where("not link").select(F.col("a").alias("hub"), F.col("b").alias("node"))
            off = materialize(member.join(apart, ["hub", "node"]).select("bucket", "node", "size"), "link-strays")
            # once the buckets are those of a finer signature, bounded ones are not taken apart any more
            whole = F.col("apart") <= few if turn == 0 else (F.col("apart") <= few * few) | (F.col("size") <= small)
            apart = off.groupBy("bucket").agg(F.count("*").alias("apart"), F.max("size").alias("size"))
            apart = materialize(apart.select("bucket", whole.alias("whole")), "link-apart")
            off = off.select("bucket", "node", F.lit(True).alias("lead"))
            tiny = tiny.unionByName(member.join(apart.where("whole"), "bucket").join(off, ["bucket", "node"], "left")
                                    .select("bucket", "node", F.coalesce("lead", F.lit(False)).alias("lead")))
            member = member.join(apart.where("not whole"), "bucket", "left_semi")
        # open: members of buckets that still hold several components
        hub_part = part.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
        spread = member.join(part, "node").join(hub_part, "hub")
        open_ = (spread.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                              F.max("hub_component").alias("h"))
                 .where("lo <> hi or lo <> h").select("bucket"))
        # lists are written before they are joined: a plain exchange on both sides lets Spark split hot keys
        open_ = materialize(open_, "link-open-buckets")
        spread = materialize(spread.join(open_, "bucket").select("hub", "node", "component").distinct(), "link-open")
        if spread.isEmpty():
            break
        if finer is not None and turn == 0:
            members = spread.select("node").unionByName(spread.select(F.col("hub").alias("node"))).distinct()
            buckets = materialize(finer(members.join(sets, "node").select("node", "body")), "link-finer")
            mixed = (buckets.join(part, "node").groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                     .where("lo <> hi").select("bucket"))
            buckets = materialize(buckets.join(mixed, "bucket"), "link-finer-open")
            if buckets.isEmpty():
                break
            continue
        buckets = materialize(_refine(spread, found, sets, num, den, expand), "link-refined")
        if buckets.isEmpty():
            break
        largest = buckets.groupBy("bucket").count().agg(F.max("count").alias("m")).first()["m"]
        final = largest <= small or turn == last - 1
    rest = tiny.join(part, "node").join(sizes, "node")
    one = rest.where("lead").select("bucket", F.col("node").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"))
    two = rest.select("bucket", F.col("node").alias("y"), F.col("component").alias("cy"), F.col("n").alias("ny"), "lead")
    once = ~F.col("lead") | (F.col("x") < F.col("y"))
    _, part = join_up(one.join(two, "bucket").where(once & (F.col("cx") != F.col("cy")) & _fits("nx", "ny", num, den))
                      .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return part


def link_counts(part: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``node, links``: with how many sets of its component a set links, for
    all nodes of components of two or more.  ``part``: ``node, component``;
    ``sets``: ``node, n, body`` with the array of ``n`` tokens.

    Every two members of a component whose sizes allow a link are compared on
    the whole sets, in blocks, so no row stands for a pair of members."""
    several = materialize(part.groupBy("component").agg(F.count("*").alias("_m")).where("_m > 1").select("component"),
                          "count-components")
    members = part.join(several, "component").join(sets.select("node", "n"), "node")
    ranked = range_ranked(members, ["component", "n", "node"], "count-members")
    level = F.floor(F.log2(F.col("n").cast("double")))
    most = F.greatest(F.lit(1), F.least(F.lit(MEMBERS), F.floor(F.lit(float(BLOCK_TOKENS)) / F.pow(F.lit(2.0), level)))).cast("long")
    # blocks of a component in order of size: by power of two, then by rank
    place = F.struct(level.alias("level"), F.floor(F.col("rank") / most).alias("at"))
    blocks = (ranked.select("node", "component", place.alias("block"))
              .join(sets, "node").groupBy("component", "block")
              .agg(F.min("n").alias("lo"), F.max("n").alias("hi"),
                   F.collect_list(F.struct("node", "n", "body")).alias("x")))       # at most MEMBERS
    blocks = materialize(blocks, "count-blocks")
    one = blocks.select("component", F.col("block").alias("b1"), "hi")
    two = blocks.select("component", F.col("block").alias("b2"), F.col("lo").alias("lo2"))
    pairs = materialize(one.join(two, "component").where((F.col("b1") < F.col("b2")) & (F.col("hi") * den >= F.col("lo2") * num))
                        .select("component", "b1", "b2"), "count-pairs")
    left = blocks.select("component", F.col("block").alias("b1"), "x")
    right = blocks.select("component", F.col("block").alias("b2"), F.col("x").alias("y"))
    across = pairs.join(left, ["component", "b1"]).join(right, ["component", "b2"]).select("x", "y")
    within = blocks.select("x").mapInArrow(_count_links(num, den), "node long, links long")
    counted = within.unionByName(across.mapInArrow(_count_links(num, den), "node long, links long"))
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def _members(cell) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, sizes, and the member and value of every token of a block."""
    rows = cell.values
    body = rows.field("body")
    edges = body.offsets.to_numpy()
    member = np.repeat(np.arange(len(rows)), np.diff(edges))
    return (rows.field("node").to_numpy(), rows.field("n").to_numpy(), member,
            body.values.to_numpy()[edges[0]:edges[-1]])


def _count_links(num: int, den: int):
    """Links of each member of a block with the others, or, given a second
    block, of the members of each with those of the other."""
    def matrix(member, column, rows, at, width):
        first, last = np.searchsorted(column, (at, at + width))
        out = np.zeros((rows, width), np.float32)
        out[member[first:last], column[first:last] - at] = 1
        return out

    def by_column(member, token, vocabulary):
        spot = np.minimum(np.searchsorted(vocabulary, token), len(vocabulary) - 1)
        held = vocabulary[spot] == token
        order = np.argsort(spot[held], kind="stable")
        return member[held][order], spot[held][order]

    def linked(x, y):
        both = np.zeros((len(x[0]), len(y[0])), np.int64)
        vocabulary = np.intersect1d(x[3], y[3])
        if len(vocabulary):
            mx, cx = by_column(x[2], x[3], vocabulary)
            my, cy = (mx, cx) if x is y else by_column(y[2], y[3], vocabulary)
            for at in range(0, len(vocabulary), WIDTH):
                width = min(WIDTH, len(vocabulary) - at)
                one = matrix(mx, cx, len(x[0]), at, width)
                two = one if x is y else matrix(my, cy, len(y[0]), at, width)
                both += (one @ two.T).astype(np.int64)
        return both * den >= (x[1][:, None] + y[1][None, :] - both) * num

    def run(batches):
        for b in batches:
            nodes, counts = [], []
            for i in range(b.num_rows):
                x = _members(b.column(0)[i])
                if b.num_columns == 1:
                    nodes.append(x[0])
                    counts.append(linked(x, x).sum(axis=1) - 1)
                    continue
                y = _members(b.column(1)[i])
                link = linked(x, y)
                nodes += [x[0], y[0]]
                counts += [link.sum(axis=1), link.sum(axis=0)]
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(counts).astype(np.int64))],
                                                 names=["node", "links"])
    return run


def _hubs(buckets: DataFrame, score: DataFrame, inside: bool) -> DataFrame:
    """Each bucket's hub: the member that is in most buckets, or, unless it
    has to be ``inside``, a better one that this member meets elsewhere.  A hub
    is only a set to compare with, so buckets of one cluster should agree on it."""
    best = materialize(buckets.join(score, "node").groupBy("bucket")
                       .agg(F.max(F.struct("score", "node")).alias("best"), F.count("*").alias("size")), "link-best")
    if inside:
        return best.select("bucket", F.col("best.node").alias("hub"), "size")
    lead = buckets.join(best, "bucket").groupBy("node").agg(F.max("best").alias("lead"))
    return (best.join(lead, F.col("best.node") == F.col("node"))
            .select("bucket", F.col("lead.node").alias("hub"), "size"))


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int, expand, compare=None) -> DataFrame:
    """``a, b, link`` for distinct pairs, on the whole sets."""
    one = sets.select(F.col("node").alias("a"), F.col("body").alias("x"), F.col("n").alias("nx"))
    two = sets.select(F.col("node").alias("b"), F.col("body").alias("y"), F.col("n").alias("ny"))
    if compare:
        return compare(pairs.join(one, "a").join(two, "b"))
    both = F.size(F.array_intersect(expand(F.col("x")), expand(F.col("y")))).cast("long")
    joined = pairs.join(one, "a").join(two, "b").withColumn(
        "both", F.when(_fits("nx", "ny", num, den), both).otherwise(F.lit(0).cast("long")))
    return joined.select("a", "b", (F.col("both") * den >= (F.col("nx") + F.col("ny") - F.col("both")) * num).alias("link"))


def _fits(x: str, y: str, num: int, den: int) -> Column:
    """Sizes whose ratio alone does not forbid a link."""
    return F.least(x, y) * den >= F.greatest(x, y) * num


def _pairs_left(buckets: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs left in refined buckets: across components, one member at
    least unlinked with the hub, the differences long enough to overlap."""
    one = buckets.select("bucket", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("open").alias("oa"),
                         F.col("delta").alias("da"), F.col("usable").alias("ua"), F.col("n").alias("na"))
    two = buckets.select("bucket", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("open").alias("ob"),
                         F.col("delta").alias("db"), F.col("usable").alias("ub"), F.col("n").alias("nb"))
    apart = F.floor((F.col("na") + F.col("nb")) * (den - num) / (den + num))
    need = F.ceil((F.col("da") + F.col("db") - apart) / 2)
    return (one.join(two, "bucket")
            .where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (F.col("oa") | F.col("ob"))
                   & (need <= F.least("ua", "ub")) & _fits("na", "nb", num, den))
            .select("a", "b").distinct())


def _refine(spread: DataFrame, found: DataFrame, sets: DataFrame, num: int, den: int, expand) -> DataFrame:
    """Next buckets ``(hub, token)``: tokens in which members differ from the hub."""
    h = sets.select(F.col("node").alias("hub"), F.col("body").alias("hub_body"))
    m = sets.select("node", "n", "body")
    known = found.select(F.col("a").alias("hub"), F.col("b").alias("node"), "link")
    delta = (spread.join(known, ["hub", "node"]).join(h, "hub").join(m, "node")
             .select("hub", "node", "component", "n", (~F.col("link")).alias("open"),
                     expand(F.col("body")).alias("mine"), expand(F.col("hub_body")).alias("its"))
             .select("hub", "node", "component", "n", "open",
                     F.array_union(F.array_except("mine", "its"), F.array_except("its", "mine")).alias("tokens")))
    delta = materialize(delta.withColumn("delta", F.size("tokens").cast("long")), "link-deltas")
    each = delta.select("hub", "node", F.explode("tokens").alias("token"))
    often = materialize(each.groupBy("hub", "token").agg(F.count("*").alias("df")).where("df > 1"), "link-tokens")
    most = F.floor(F.col("n") * (den - num) / num)
    # how far the rarest-first prefix must reach for every possible partner
    reach = F.when(F.col("open"), F.least(F.col("delta"), most + 1)).otherwise(
        F.col("delta") - F.ceil(F.col("delta") * (0.5 - (den - num) / (den + num) / 2) - 1e-9) + 1)
    slim = delta.select("hub", "node", "component", "n", "open", "delta")
    rare = Window.partitionBy("hub", "node").orderBy("df", "token")
    usable = (each.join(often, ["hub", "token"])
              .withColumn("usable", F.count("*").over(Window.partitionBy("hub", "node")))
              .withColumn("r", F.row_number().over(rare)))
    # tokens nobody else has come first in the order and meet nobody
    alone = F.col("delta") - F.col("usable")
    rows = (usable.join(slim, ["hub", "node"]).where(F.col("r") + alone <= reach)
            .select(F.xxhash64("hub", "token").alias("bucket"), "node", "component", "n", "open", "delta", "usable"))
    rows = materialize(rows, "link-prefixes")
    worth = (rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("open").alias("o"))
             .where("lo <> hi and o").select("bucket"))
    worth = materialize(worth, "link-worth")
    return rows.join(worth, "bucket").distinct()
