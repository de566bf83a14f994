"""Prefix trie of conversations, with totals over every subtree by parallel tree contraction.

A prefix is known by two running sums of 60-bit hashes of its turns, each hash taken together with its depth,
so equal prefixes have equal sums whatever conversation they come from, and no conversation is ever held
as a list.  Grouping by depth and sums gives the nodes; a node is named by its smallest member and its depth.

Subtree totals never walk the tree level by level.  Rounds of joins shrink it: *rake* adds every leaf to its
parent and removes it, *compress* takes out chain nodes (one child left) that are next to no other
node taken out, and hangs the child on their parent.  When only the roots are left the rounds are undone in
reverse: a raked leaf's total was known, a compressed node's total is its own weight plus its child's total.
A tree of n nodes takes a number of rounds that grows with log n, a single chain of turns as well.

Edge cases: rows with a null conversation id are left out; null roles and texts become empty.  A
conversation's turns are ordered by turn, null first, and then by hashes of role and text, so repeated turns
have a fixed order and each counts as a turn of its own.  A base id that no conversation has gives no
turns; a conversation may be left without turns and then ends at the root.  Empty tables give no nodes.
Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.operators.joins import join_one
from stayflow.operators.ordered import arrange
from stayflow.sources.scratch import keep

ENDS_PER_BLOCK = 4096

# -- turns, rebuilt from a shared base ------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, two hashes of role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat_ws(":", F.length(role), role, text), 256)
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        # 60 bits each
        *[F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(n) for at, n in ((1, "_a"), (16, "_b"))],
        F.length(text).cast("long").alias("n_chars"),
    )


def _step(depth: Column) -> list[Column]:
    """The two numbers that a turn at this depth adds to the sums of its prefix."""
    return [
        F.shiftrightunsigned(F.xxhash64("_a", "_b", depth.cast("long"), F.lit(seed)), 4).cast("decimal(20,0)")
        for seed in (1, 2)
    ]


_SUM = "decimal(38,0)"  # 60-bit hashes: room for 10 ** 19 turns
_HEAD = f"array<struct<depth:long,p:{_SUM},q:{_SUM},n_chars:long>>"


def _heads(turns: DataFrame, most: int) -> DataFrame:
    """The first ``most`` turns of each conversation with the sums up to them, as one short array."""
    order = Window.partitionBy("conv_id").orderBy("turn", "_a", "_b")
    first = turns.withColumn("depth", F.row_number().over(order).cast("long")).filter(F.col("depth") <= most)
    p, q = _step(F.col("depth"))
    first = first.withColumns({"p": p, "q": q})
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = first.withColumns({c: F.sum(c).over(so_far).cast(_SUM) for c in ("p", "q")})
    turn = F.struct("depth", "p", "q", "n_chars")
    return first.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).cast(_HEAD).alias("_head"))


def shared_prefixes(turns: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``shared`` turns are replaced by those of conversation ``base``.

    ``base`` and ``shared`` (at most ``most``) are expressions of ``conv_id``.  Returns the prefixes, one
    row per conversation and turn (``conv_id, depth, p, q, p_before, q_before, n_chars``), and the
    conversations (``conv_id, n_turns, p, q``: the sums of the whole).
    """
    of = turns.groupBy("conv_id").agg(F.count("*").alias("_own")).withColumns({"_base": base, "_shared": shared.cast("long")})
    bases = of.select(F.col("_base").alias("conv_id")).distinct()
    heads = _heads(join_one(turns, bases, ["conv_id"], "left_semi"), most)
    of = of.join(heads.withColumnRenamed("conv_id", "_base"), "_base", "left").withColumn(
        "_head", F.slice(F.coalesce("_head", F.array().cast(_HEAD)), F.lit(1), F.col("_shared"))
    )
    last = F.try_element_at("_head", F.lit(-1))
    of = keep(
        of.select(
            "conv_id",
            "_shared",
            "_head",
            F.size("_head").cast("long").alias("_taken"),
            F.coalesce(last["p"], F.lit(0)).cast(_SUM).alias("_p"),
            F.coalesce(last["q"], F.lit(0)).cast(_SUM).alias("_q"),
            F.greatest(F.col("_own") - F.col("_shared"), F.lit(0)).alias("_rest"),
        )
    )
    own = join_one(turns, of.select("conv_id", "_shared", "_taken", "_p", "_q"), ["conv_id"])
    own = arrange(own, ["conv_id"], ["turn", "_a", "_b"]).running(_at=("sum", F.lit(1)))
    own = own.filter(F.col("_at") > F.col("_shared")).with_columns(
        {"depth": (F.col("_taken") + F.col("_at") - F.col("_shared")).cast("long")}
    )
    p, q = _step(F.col("depth"))
    own = own.with_columns({"_dp": p, "_dq": q}).running(_sp=("sum", "_dp"), _sq=("sum", "_dq"))
    own = own.df.select(
        "conv_id",
        "depth",
        (F.col("_p") + F.col("_sp")).cast(_SUM).alias("p"),
        (F.col("_q") + F.col("_sq")).cast(_SUM).alias("q"),
        (F.col("_p") + F.col("_sp") - F.col("_dp")).cast(_SUM).alias("p_before"),
        (F.col("_q") + F.col("_sq") - F.col("_dq")).cast(_SUM).alias("q_before"),
        "n_chars",
    )
    number = F.col("_at") - 2
    before = F.when(F.col("_at") > 1, F.get("_head", number))
    shared_rows = of.select("conv_id", "_head", F.posexplode("_head").alias("_at", "_turn")).withColumn("_at", F.col("_at") + 1)
    shared_rows = shared_rows.select(
        "conv_id",
        F.col("_turn.depth").alias("depth"),
        F.col("_turn.p").alias("p"),
        F.col("_turn.q").alias("q"),
        F.coalesce(before["p"], F.lit(0)).cast(_SUM).alias("p_before"),
        F.coalesce(before["q"], F.lit(0)).cast(_SUM).alias("q_before"),
        F.col("_turn.n_chars").alias("n_chars"),
    )
    prefixes = keep(shared_rows.unionByName(own))
    return prefixes, of.select("conv_id", (F.col("_taken") + F.col("_rest")).alias("n_turns"))


# -- nodes ----------------------------------------------------------------------------------


def build(prefixes: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_chars`` and the prefix sums.

    ``n_chars`` is the length of the node's last text.  The root is the smallest conversation at depth 0.
    """
    found = prefixes.groupBy("depth", "p", "q").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("p_before").alias("p_before"),
        F.min("q_before").alias("q_before"),
        F.min("n_chars").alias("n_chars"),
    )
    found = keep(found)
    zero = F.lit(0).cast(_SUM)
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = keep(root.select(F.lit(0).cast("long").alias("depth"), zero.alias("p"), zero.alias("q"), "conv_id", "n_convs", F.lit(0).cast("long").alias("n_chars")))
    top = root.agg(F.min("conv_id")).scalar()
    names = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("p").alias("p_before"), F.col("q").alias("q_before"), F.col("conv_id").alias("parent_conv_id")
    )
    deep = join_one(found.filter("depth > 1"), names, ["depth", "p_before", "q_before"])
    placed = found.filter("depth = 1").withColumn("parent_conv_id", top).unionByName(deep)
    placed = placed.drop("p_before", "q_before").unionByName(root.withColumn("parent_conv_id", F.lit(None).cast("long")))
    placed = keep(placed)
    children = placed.filter("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    out = placed.join(children, ["conv_id", "depth"], "left")
    return keep(out.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))


# -- tree contraction -----------------------------------------------------------------------


def subtree_totals(tree: DataFrame, key: list[str], parent: list[str], weights: list[str]) -> DataFrame:
    """``key`` and each weight summed over the node's subtree, the node included.

    ``key`` names a node by one or more whole numbers, ``parent`` its parent (all null for a root); there may
    be several trees.  Weights are numbers and null counts as 0.
    """
    up = dict(zip(key, [f"_up_{k}" for k in key]))
    extra = {w: f"_edge_{w}" for w in weights}  # weights of the nodes taken out between a node and its parent
    live = tree.select(
        *key,
        *[F.col(p).alias(up[k]) for k, p in zip(key, parent)],
        *[F.coalesce(F.col(w), F.lit(0)).cast("long").alias(w) for w in weights],
        *[F.lit(0).cast("long").alias(e) for e in extra.values()],
    )
    is_root = F.col(up[key[0]]).isNull()
    sizes = live.filter(~is_root).groupBy(*up.values()).agg(F.count("*").alias("_kids"))
    sizes = sizes.withColumnsRenamed({u: k for k, u in up.items()})
    live = keep(live.join(sizes, key, "left").withColumn("_kids", F.coalesce("_kids", F.lit(0))))
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not live.filter(~is_root).isEmpty():
        raked = live.filter((F.col("_kids") == 0) & ~is_root).select(*key, *weights)
        near = keep(_rake(live, key, up, weights, extra))
        taken = keep(_independent(near, key, up, len(rounds)))
        changes = keep(_splice(near, taken, key, up, weights, extra))
        rounds.append((raked, changes.filter("_gone").select(*key, *[f"_kid_{k}" for k in key], *[F.col(f"_add_{w}").alias(w) for w in weights])))
        live = keep(_apply(near, changes, key, up, weights, extra))
    totals = live.select(*key, *weights)
    for raked, taken in reversed(rounds):
        below = totals.select(*[F.col(k).alias(f"_kid_{k}") for k in key], *[F.col(w).alias(f"_below_{w}") for w in weights])
        opened = taken.join(below, [f"_kid_{k}" for k in key]).select(
            *key, *[(F.col(w) + F.col(f"_below_{w}")).alias(w) for w in weights]
        )
        totals = keep(totals.unionByName(raked).unionByName(opened))
    return totals


def _rake(live: DataFrame, key: list[str], up: dict, weights: list[str], extra: dict) -> DataFrame:
    """The nodes that are no leaves, with their leaves' weights, and the child of those with one child left.

    Children are added up by parent before the shuffle, so a parent of very many is no burden.
    """
    leaf = F.col("_kids") == 0
    by_parent = live.filter(F.col(up[key[0]]).isNotNull()).groupBy(*up.values()).agg(
        F.count(F.when(~leaf, 1)).alias("_left"),
        *[F.sum(F.when(leaf, F.col(w) + F.col(extra[w]))).alias(f"_raked_{w}") for w in weights],
        # read only where a single child is left
        *[F.min(F.when(~leaf, F.col(k))).alias(f"_kid_{k}") for k in key],
        *[F.min(F.when(~leaf, F.col(extra[w]))).alias(f"_kid_edge_{w}") for w in weights],
    )
    by_parent = by_parent.withColumnsRenamed({u: k for k, u in up.items()})
    rest = live.filter(~leaf | F.col(up[key[0]]).isNull())
    return rest.join(by_parent, key, "left").select(
        *key,
        *up.values(),
        *[(F.col(w) + F.coalesce(f"_raked_{w}", F.lit(0))).alias(w) for w in weights],
        *extra.values(),
        F.coalesce("_left", F.lit(0)).alias("_kids"),
        *[f"_kid_{k}" for k in key],
        *[f"_kid_edge_{w}" for w in weights],
    )


def _independent(near: DataFrame, key: list[str], up: dict, number: int) -> DataFrame:
    """Keys of chain nodes of which no two are parent and child; in a chain about half of them.

    Of two neighbours the one whose last key (the depth) divides by the higher power of two stays; ties are broken by
    a hash that changes from round to round, so that the set is large for any numbering.
    """
    power = F.expr(f"bit_count((`{key[-1]}` & -`{key[-1]}`) - 1)")
    chain = near.filter((F.col("_kids") == 1) & F.col(up[key[0]]).isNotNull())
    chain = chain.select(*key, *[f"_kid_{k}" for k in key], F.struct(power.alias("power"), F.xxhash64(*key, F.lit(number)).alias("mix"), *key).alias("_stays"))
    child = chain.select(*[F.col(k).alias(f"_kid_{k}") for k in key], F.col("_stays").alias("_kid_stays"))
    both = chain.join(child, [f"_kid_{k}" for k in key])
    first = F.col("_stays") < F.col("_kid_stays")
    kept = both.select(*[F.when(first, F.col(f"_kid_{k}")).otherwise(F.col(k)).alias(k) for k in key]).distinct()
    return chain.select(*key).join(kept, key, "left_anti")


def _splice(near: DataFrame, taken: DataFrame, key: list[str], up: dict, weights: list[str], extra: dict) -> DataFrame:
    """For each chain node taken out: that it is gone, and the new parent of its child."""
    out = near.join(taken, key)
    gone = out.select(
        *key,
        F.lit(True).alias("_gone"),
        *[f"_kid_{k}" for k in key],
        *[F.lit(None).cast("long").alias(f"_new_{k}") for k in key],
        *[(F.col(w) + F.col(f"_kid_edge_{w}")).alias(f"_add_{w}") for w in weights],
    )
    moved = out.select(
        *[F.col(f"_kid_{k}").alias(k) for k in key],
        F.lit(False).alias("_gone"),
        *[F.lit(None).cast("long").alias(f"_kid_{k}") for k in key],
        *[F.col(up[k]).cast("long").alias(f"_new_{k}") for k in key],
        *[(F.col(w) + F.col(extra[w])).alias(f"_add_{w}") for w in weights],
    )
    return gone.unionByName(moved)


def _apply(near: DataFrame, changes: DataFrame, key: list[str], up: dict, weights: list[str], extra: dict) -> DataFrame:
    joined = near.drop(*[f"_kid_{k}" for k in key], *[f"_kid_edge_{w}" for w in weights]).join(
        changes.drop(*[f"_kid_{k}" for k in key]), key, "left"
    )
    left = joined.filter(~F.coalesce("_gone", F.lit(False)))
    moved = F.col("_gone").isNotNull()
    return left.select(
        *key,
        *[F.when(moved, F.col(f"_new_{k}")).otherwise(F.col(u)).alias(u) for k, u in up.items()],
        *weights,
        *[F.when(moved, F.col(e) + F.col(f"_add_{w}")).otherwise(F.col(e)).alias(e) for w, e in extra.items()],
        "_kids",
    )


# -- where conversations end ----------------------------------------------------------------


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each group's blocks, end to end; one running hash is held, whatever a group's size."""
    group, running, names, found = None, None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array([n[k] for n in names], pa.decimal128(38, 0) if k else pa.int64()) for k in range(3)] + [pa.array(found, pa.string())],
            ["depth", "p", "q", "ends_sha256"],
        )
        names.clear()
        found.clear()

    for batch in batches:
        for depth, p, q, part in zip(*[batch[c].to_pylist() for c in ("depth", "p", "q", "part")]):
            if (depth, p, q) != group:
                if group is not None:
                    names.append(group)
                    found.append(running.hexdigest())
                group, running = (depth, p, q), hashlib.sha256(part.encode())
            else:
                running.update(b"," + part.encode())
        if len(names) >= 10_000:
            yield from flush()
    if group is not None:
        names.append(group)
        found.append(running.hexdigest())
    if names:
        yield from flush()


def ends(prefixes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``depth, p, q, ends_sha256``: the hash of the ids of the conversations that end at a node, in order.

    The ids of a node are put in order by ranges, so a node with very many is spread over tasks, and joined
    to blocks there.  Only the blocks come together, and they are hashed one after the other.
    """
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "p", "q")).alias("_last"))
    zero = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(0).cast(_SUM).alias("p"), F.lit(0).cast(_SUM).alias("q"))
    at = conversations.select("conv_id").join(last, "conv_id", "left").select("conv_id", F.coalesce("_last", zero).alias("_last"))
    at = at.select("conv_id", "_last.*")
    node = ["depth", "p", "q"]
    ranged = at.repartitionByRange(*node, "conv_id").withColumn("_range", F.spark_partition_id())
    number = F.row_number().over(Window.partitionBy("_range", *node).orderBy("conv_id"))
    blocks = keep(ranged).withColumn("_block", F.floor((number - 1) / ENDS_PER_BLOCK))
    ids = F.array_sort(F.collect_list("conv_id"))
    blocks = blocks.groupBy("_range", *node, "_block").agg(ids.alias("_ids"), F.min("conv_id").alias("_from"))
    part = F.array_join(F.transform("_ids", lambda i: i.cast("string")), ",")
    ordered = blocks.select(*node, "_from", part.alias("part")).repartition(*[F.col(c) for c in node]).sortWithinPartitions(*node, "_from")
    return ordered.mapInArrow(_hash_blocks, f"depth long, p {_SUM}, q {_SUM}, ends_sha256 string")
