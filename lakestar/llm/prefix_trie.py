"""Operator 11: trie of the prefixes that conversations share, measured by the Euler-tour technique.

A node is a distinct sequence of first turns; it is named by its smallest member and its depth. The tour enters and
leaves every node once: each node has an enter and an exit arc, and each arc names the one after it. The list of arcs is
ranked without following it link by link: chains inside a block of nodes are contracted by numpy, what is left loses about
a quarter of its elements per round (an element that drew 0 is taken over by a predecessor that drew 1), and the last few
thousand are ranked in one small task. Going back over the rounds gives every arc its place in the tour and the sums of
leaves and savings up to there; a subtree's total is the difference between its exit and its enter arc.

Nothing is gathered per conversation or per node: places in a conversation, prefix hashes and families (a parent with its
children) come from tables sorted over all tasks, with sums carried from range to range. Prefixes are told apart by 128-bit
sums of the hashes of their (place, role, text).

Defined results: rows without a conv_id belong to no conversation; NULL role or text is empty; rows of a conversation come
by turn (NULL first), rows of one turn by the MD5 of role and then of text, repeated rows count as turns; other columns
are not read; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestar.llm.common import staged
from lakestar.operators.keys import PART, POS, by_part, dense_key, last_positions, sorted_table

# Nodes whose arcs one task contracts together, elements that one task ranks at last, and ids per piece of an id list.
BLOCK, LAST, LISTED = 1 << 15, 1 << 14, 4_096
WORD = r"[^\x20\x09-\x0D]+"

# A prefix's hash in four parts of 32 bits, so that no sum of them overflows.
_PARTS = ["s0", "s1", "s2", "s3"]
_LOW = 0xFFFFFFFF
_WEIGHTS = ["arcs", "leaves", "saved"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, words, row): digests in place of texts, which are not needed any more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.coalesce(F.col("role"), F.lit("")).cast("binary"))).alias("role"),
        F.unhex(F.md5(text.cast("binary"))).alias("text"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        # Copies of a row differ in this, so that a sort can deal them to different tasks.
        F.monotonically_increasing_id().alias("row"),
    )


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Add the running sum of each value over the rows of a key, in order and with the row itself.

    The rows are sorted over all tasks, so one key may hold any share of them; a key that goes on from one range to the next
    is carried over by the sums of its ranges, at most two rows per range.
    """
    table = sorted_table(df, [*keys, *order])
    last = last_positions(table)
    so_far = Window.partitionBy(PART, *keys).orderBy(POS)
    inside = table.withColumns({name: F.sum(value).over(so_far) for name, value in values.items()})
    per = table.groupBy(PART, *keys).agg(*[F.sum(v).alias(f"_{n}") for n, v in values.items()], F.min(POS).alias("_a"), F.max(POS).alias("_z"))
    at_border = per.where((F.col("_a") == 0) | (F.col("_z") == by_part(last)))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = at_border.select(PART, *keys, *[F.sum(f"_{n}").over(before).alias(f"_{n}") for n in values])
    joined = inside.join(F.broadcast(carried), [PART, *keys], "left")
    sums = [(F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in values]
    return joined.select(*df.columns, *sums)


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, words): the rows of each conversation numbered from 0."""
    placed = running(rows, ["conv_id"], ["turn", "role", "text", "row"], {"place": F.lit(1).cast("long")})
    return placed.select("conv_id", (F.col("place") - 1).alias("place"), "role", "text", "words")


def rebuild(steps: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: each conversation c starts with the first h turns of conversation c - c % group,
    then come its own turns after its first h, where h is crc32(c) % most. Returns the steps and all conv_ids.

    ``steps`` is read more than once and must be a written table.
    """
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = steps.groupBy("conv_id").agg(F.min("place").alias("_first"))
    ids = staged(ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), opening.alias("h")), "ids")
    heads = steps.where(F.col("place") < most - 1).withColumnRenamed("conv_id", "base")
    taken = ids.join(heads, "base").where("place < h").select("conv_id", "place", "role", "text", "words")
    taken = staged(taken, "openings")
    # Fewer turns than h in the base move the own turns forward; only such conversations are looked up.
    given = taken.groupBy("conv_id").agg(F.count("*").alias("n"))
    short = ids.join(given, "conv_id", "left").withColumn("less", F.col("h") - F.coalesce(F.col("n"), F.lit(0))).where("less > 0")
    short = staged(short.select("conv_id", "less"), "short")
    own = steps.where(F.col("place") >= opening).join(short, "conv_id", "left")
    own = own.select("conv_id", (F.col("place") - F.coalesce(F.col("less"), F.lit(0))).alias("place"), "role", "text", "words")
    return taken.unionByName(own), ids.select("conv_id")


def _prefixes(steps: DataFrame) -> DataFrame:
    """(conv_id, depth, s0..s3, p0..p3, words): the hash of each prefix, and that of the prefix without its last turn."""
    one, two = F.xxhash64("place", "role", "text"), F.xxhash64(F.lit(1), "text", "role", "place")
    parts = [half for h in (one, two) for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(_LOW))]
    hashed = steps.select("conv_id", "place", "words", *[part.alias(f"_h{i}") for i, part in enumerate(parts)])
    summed = running(hashed, ["conv_id"], ["place"], {s: F.col(f"_h{i}") for i, s in enumerate(_PARTS)})
    own = [F.col(s).bitwiseAND(_LOW).alias(s) for s in _PARTS]
    parent = [(F.col(s) - F.col(f"_h{i}")).bitwiseAND(_LOW).alias(f"p{i}") for i, s in enumerate(_PARTS)]
    return summed.select("conv_id", (F.col("place") + 1).alias("depth"), *own, *parent, "words")


def _nodes(prefixes: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node with its number from 1 by (conv_id, depth)."""
    inner = prefixes.groupBy("depth", *_PARTS).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("words").alias("words"),
        *[F.min(f"p{i}").alias(f"p{i}") for i in range(4)],
    )
    zero = F.lit(0).cast("long")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("depth"), *[zero.alias(s) for s in _PARTS], "conv_id", "n_convs", zero.alias("words"),
        *[F.lit(None).cast("long").alias(f"p{i}") for i in range(4)],
    )
    return staged(dense_key(inner.unionByName(root), ["conv_id", "depth"], "node"), "nodes")


def _families(nodes: DataFrame) -> DataFrame:
    """(node, parent, parent_conv_id, sibling, child, n_children): who follows whom in the tour.

    Each node stands once as a parent and once as a child in one table sorted by family, the parent before its children:
    the first child is the row after the parent, the next sibling the row after a child, and the parent of a child the last
    parent row so far. Both reach over ranges by one row per range, so a parent may have any number of children.
    """
    as_parent = nodes.select("depth", *_PARTS, F.lit(0).alias("kind"), "conv_id", "node")
    as_child = nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), *[F.col(f"p{i}").alias(s) for i, s in enumerate(_PARTS)], F.lit(1).alias("kind"), "conv_id", "node"
    )
    key = ["depth", *_PARTS]
    table = sorted_table(as_parent.unionByName(as_child), [*key, "kind", "conv_id", "node"])
    parts = sorted(last_positions(table))
    # What a row says to the one before it, and what a parent says to those after it.
    follows = F.when(F.col("kind") == 1, F.col("node"))
    parent = F.when(F.col("kind") == 0, F.struct("node", "conv_id"))
    previous = by_part(dict(zip(parts[1:], parts, strict=False)))
    heads = table.where((F.col(POS) == 0) & (F.col(PART) != (parts[0] if parts else 0)))
    heads = heads.select(previous.alias(PART), follows.alias("_head"))
    summary = table.groupBy(PART).agg(F.max_by(parent, F.when(F.col("kind") == 0, F.col(POS))).alias("_last"))
    # One row per range.
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    opened = summary.select(PART, F.last("_last", ignorenulls=True).over(earlier).alias("_open"))
    in_range = Window.partitionBy(PART).orderBy(POS)
    rows = table.withColumn("_next", F.lead(follows).over(in_range)).withColumn("_of", F.last(parent, ignorenulls=True).over(in_range))
    rows = rows.withColumn("_end", F.lead(F.lit(1)).over(in_range).isNull())
    rows = rows.join(F.broadcast(heads), PART, "left").join(F.broadcast(opened), PART, "left")
    after = F.when(F.col("_end"), F.col("_head")).otherwise(F.col("_next"))
    rows = rows.select("node", "kind", after.alias("after"), F.coalesce("_of", "_open").alias("of"))
    by_child = F.col("kind") == 1
    links = rows.groupBy("node").agg(
        F.max(F.when(by_child, F.col("of.node"))).alias("parent"),
        F.max(F.when(by_child, F.col("of.conv_id"))).alias("parent_conv_id"),
        F.max(F.when(by_child, F.col("after"))).alias("sibling"),
        F.max(F.when(~by_child, F.col("after"))).alias("child"),
    )
    # The root of an all but empty trie is nobody's child; counts of children are combined before their shuffle.
    children = rows.where(by_child).groupBy(F.col("of.node").alias("node")).agg(F.count("*").alias("n_children"))
    return links.join(children, "node", "left").fillna(0, ["n_children"])


def _chain_sums(ids: np.ndarray, following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For elements sorted by id: the index of the head of each one's chain, the sums from the head up to and with it, and
    whether its follower is among them. Every step looks twice as far back, so a chain of n takes log n steps."""
    n = len(ids)
    at = np.minimum(np.searchsorted(ids, following), n - 1)
    inside = ids[at] == following
    back = np.arange(n)
    back[at[inside]] = np.flatnonzero(inside)
    sums = np.where((back == np.arange(n))[:, None], 0, weights)
    while True:
        further = back[back]
        if (further == back).all():
            return back, sums + weights[back], inside
        sums, back = sums + sums[back], further


_CHAINS = "arc long, head long, tail boolean, next long, arcs long, leaves long, saved long"


def _contract(rows: pd.DataFrame) -> pd.DataFrame:
    """The arcs of one block of nodes with the head of their chain and the sums up to there."""
    rows = rows.sort_values("arc", ignore_index=True)
    arc, following = rows["arc"].to_numpy(), rows["next"].to_numpy()
    head, sums, inside = _chain_sums(arc, following, rows[_WEIGHTS].to_numpy(dtype=np.int64))
    found = {"arc": arc, "head": arc[head], "tail": ~inside, "next": following}
    return pd.DataFrame(found | dict(zip(_WEIGHTS, sums.T, strict=True)))


def _rank_few(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [batch for batch in batches if len(batch)]
    if rows:
        few = pd.concat(rows).sort_values("id", ignore_index=True)
        weights = few[_WEIGHTS].to_numpy(dtype=np.int64)
        _, sums, _ = _chain_sums(few["id"].to_numpy(), few["next"].to_numpy(), weights)
        yield pd.DataFrame({"id": few["id"]} | dict(zip(_WEIGHTS, (sums - weights).T, strict=True)))


def rank_list(elements: DataFrame, last: int = LAST) -> DataFrame:
    """(id, arcs, leaves, saved): what comes before each element of one linked list (id, next, and the weights; -1 follows the
    last one).

    In every round an element that draws 1 takes over a follower that draws 0, so about a quarter goes; the numbers drawn
    are hashes of the ids, so a task that runs again draws the same. The rounds' tables are written, and read again backwards.
    """
    rounds: list[DataFrame] = []
    while elements.count() > last:
        n = len(rounds)
        drew_one = lambda c, n=n: F.pmod(F.xxhash64(F.lit(n), F.col(c)), F.lit(2)) == 1
        takes = drew_one("id") & ~drew_one("next") & (F.col("next") >= 0)
        takers = elements.where(takes).select(F.col("id").alias("by"), F.col("next").alias("id"), *[F.col(w).alias(f"_{w}") for w in _WEIGHTS])
        none = [F.lit(None).cast("long").alias(c) for c in ["by", *[f"_{w}" for w in _WEIGHTS]]]
        met = elements.where(~drew_one("id")).join(takers, "id", "left")
        rest = elements.where(drew_one("id") & ~takes).select("*", *none)
        table = staged(met.unionByName(rest), "round")
        rounds.append(table.where("by IS NOT NULL"))
        elements = table.select(
            F.coalesce("by", "id").alias("id"), "next", *[(F.col(w) + F.coalesce(F.col(f"_{w}"), F.lit(0))).alias(w) for w in _WEIGHTS]
        )
    # At most ``last`` rows.
    ranks = staged(elements.coalesce(1).mapInPandas(_rank_few, "id long, arcs long, leaves long, saved long"), "ranks")
    for taken in reversed(rounds):
        before = ranks.select(F.col("id").alias("by"), *[F.col(w).alias(f"r_{w}") for w in _WEIGHTS])
        more = taken.join(before, "by").select("id", *[(F.col(f"r_{w}") + F.col(f"_{w}")).alias(w) for w in _WEIGHTS])
        ranks = staged(ranks.unionByName(more), "ranks")
    return ranks


def _tour(links: DataFrame, nodes: DataFrame, block: int, last: int) -> DataFrame:
    """(node, enter_at, exit_at, n_leaves, saved_tokens) by places and sums along the Euler tour.

    Node v enters as arc 2v and exits as arc 2v + 1. Weights lie on the exits, so a subtree with its top is what the tour
    has gathered at the exit and not yet at the enter.
    """
    rows = links.join(nodes.select("node", "n_convs", "words"), "node")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    node, leaf = F.col("node"), F.when(F.col("n_children") == 0, one).otherwise(zero)
    enter = F.struct(
        (2 * node).alias("arc"), F.coalesce(2 * F.col("child"), 2 * node + 1).alias("next"), one.alias("arcs"), zero.alias("leaves"), zero.alias("saved")
    )
    exit_ = F.struct(
        (2 * node + 1).alias("arc"),
        F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1, F.lit(-1)).cast("long").alias("next"),
        one.alias("arcs"), leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    arcs = rows.select(F.floor(node / block).alias("block"), F.explode(F.array(enter, exit_)).alias("a")).select("block", "a.*")
    chains = staged(arcs.groupBy("block").applyInPandas(_contract, _CHAINS), "chains")
    ranks = rank_list(chains.where("tail").select(F.col("head").alias("id"), "next", *_WEIGHTS), last)
    before = ranks.select(F.col("id").alias("head"), *[F.col(w).alias(f"_{w}") for w in _WEIGHTS])
    placed = chains.join(before, "head").select("arc", *[(F.col(w) + F.col(f"_{w}")).alias(w) for w in _WEIGHTS])
    leaves = F.col("arc") % 2 == 1
    gathered = lambda w: F.sum(F.when(leaves, F.col(w)).otherwise(-F.col(w)))
    return placed.groupBy(F.floor(F.col("arc") / 2).alias("node")).agg(
        F.min(F.col("arcs") - 1).alias("enter_at"),
        F.max(F.col("arcs") - 1).alias("exit_at"),
        gathered("leaves").alias("n_leaves"),
        gathered("saved").alias("saved_tokens"),
    )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list, whose pieces come one after another; only one piece is held at a time."""
    open_key, digest, done = None, None, []
    names = ["depth", *_PARTS, "ends_sha256"]

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * len(names)
        types = [pa.int64()] * (len(names) - 1) + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        *key, _, _, listed = batch.columns
        for values in zip(*[c.to_pylist() for c in key], listed.to_pylist(), strict=True):
            if values[:-1] == open_key:
                digest.update(b"," + values[-1].encode())
                continue
            if digest:
                done.append((*open_key, digest.hexdigest()))
            open_key, digest = values[:-1], hashlib.sha256(values[-1].encode())
        if len(done) >= 10_000:
            yield out()
            done = []
    if digest:
        done.append((*open_key, digest.hexdigest()))
    yield out()


def _ends(prefixes: DataFrame, ids: DataFrame) -> DataFrame:
    """(depth, s0..s3, ends_sha256) of the nodes where conversations end: the digest of their ids in ascending order.

    Ids are sorted over all tasks and joined in pieces; a digest is sequential, so one task reads the pieces of a node, as a
    stream.
    """
    key = ["depth", *_PARTS]
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("end"))
    zero = F.lit(0).cast("long")
    ends = ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(F.col(f"end.{k}"), zero).alias(k) for k in key])
    table = sorted_table(ends, [*key, "conv_id"])
    listed = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")))
    pieces = table.groupBy(*key, PART, F.floor(F.col(POS) / LISTED).alias("piece")).agg(listed.alias("listed"))
    dealt = pieces.repartition(*key).sortWithinPartitions(*key, PART, "piece")
    schema = ", ".join(f"{k} long" for k in key) + ", ends_sha256 string"
    return dealt.select(*key, PART, "piece", "listed").mapInArrow(_digests, schema)


def build_trie(steps: DataFrame, ids: DataFrame, block: int = BLOCK, last: int = LAST) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, enter_at, exit_at.

    ``steps`` has (conv_id, place, role, text, words) with places from 0 without gaps; ``ids`` all conv_ids, those without steps
    included.
    """
    prefixes = staged(_prefixes(steps), "prefixes")
    nodes = _nodes(prefixes, ids)
    links = staged(_families(nodes), "families")
    measured = _tour(links, nodes, block, last)
    ends = _ends(prefixes, ids)
    rows = nodes.select("node", "conv_id", "depth", *_PARTS, "n_convs").join(links.select("node", "parent_conv_id", "n_children"), "node")
    rows = rows.join(measured, "node").join(ends, ["depth", *_PARTS], "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "enter_at", "exit_at",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    steps = staged(numbered(turns(conversations)), "steps")
    return build_trie(steps, staged(steps.select("conv_id").distinct(), "ids"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations with shared openings (see ``rebuild``)."""
    return build_trie(*rebuild(staged(numbered(turns(conversations)), "steps")))
