"""From shared keys to components: candidate pairs, exact checks, distributed union-find."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch, few_enough

#: A key with up to so many nodes pairs them all; of a larger one the first node is paired with each other.
SMALL = 16
#: Similarity in hundredths that the size and position filters hold pairs to.
SIMILAR = 75


def connected_components(edges: DataFrame, scratch: Scratch, rows: int | None = None) -> DataFrame:
    """node, component (the smallest node reachable) of every node that has an edge (a, b) to another; rows: a bound of the edges.

    Alternates large-star and small-star steps: each node hands its neighbours its smallest one,
    until every node points at its component's smallest.  Steps are joins and aggregations on
    nodes; each is written out, and the number of steps grows with the logarithm of the input.
    """
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), rows=rows)
    while True:
        rows = now.count()  # no step makes more edges, so it bounds the tables to come
        # done once no node points at two, or at one that points on
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(now.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        open_nodes = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or out = 1 and into = 1")
        if not open_nodes.limit(1).count():
            out = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
            out = scratch.write(out, rows=2 * rows)
            scratch.drop(now)
            return out
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = scratch.write(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), rows=2 * rows)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.write(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), rows=2 * rows)
        scratch.drop(now, large)
        now = after


def merged(parts: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """parts (node, component) after further edges (a, b), written: only the components that these touch are joined anew.  Both are dropped."""
    if not edges.limit(1).count():
        scratch.drop(edges)
        return parts
    ends = edges
    for side in ("a", "b"):
        home = parts.select(F.col("node").alias(side), F.col("component").alias("home"))
        ends = ends.join(home, side, "left").withColumn(side, F.coalesce("home", side)).drop("home")
    moves = connected_components(ends, scratch, edges.count()).select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = parts.join(moves, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    fresh = moves.select(F.col("component").alias("node"), F.col("to").alias("component")).join(parts, "node", "left_anti")
    out = scratch.write(old.unionByName(fresh), rows=parts.count() + moves.count())
    scratch.drop(moves, parts, edges)
    return out


def may_link(size_a, pos_a, size_b, pos_b, similar: int = SIMILAR):
    """Whether sets of these sizes can be similar whose first shared key has these positions (numpy arrays).

    Linked sets share at least t = similar / (100 + similar) of both sizes together, and what stands before
    the first shared key is not shared, so each has t left from there on.
    """
    t = -(-similar * (size_a + size_b) // (100 + similar))
    return (size_a - np.maximum(pos_a, 0) >= t) & (size_b - np.maximum(pos_b, 0) >= t)


def may_link_column(a: str, b: str, similar: int = SIMILAR) -> Column:
    """``may_link`` of the columns a_size, a_pos, b_size and b_pos."""
    t = f"(({similar} * ({a}_size + {b}_size) + {similar + 99}) div {100 + similar})"
    return F.expr(f"{a}_size - greatest({a}_pos, 0) >= {t} and {b}_size - greatest({b}_pos, 0) >= {t}")


def bucket_pairs(rows: DataFrame, small: int = SMALL, similar: int = SIMILAR) -> DataFrame:
    """Pairs (a, b) of nodes that share a key, and the members of large keys.

    rows: key, node and, where pairs are to be filtered, size (of the node's set) and pos (of the key in it), all long.
    Of a key with up to ``small`` nodes all pairs that may link.  Of a larger one a row for each node b but one, the
    pivot, with its key, size and pos, and a the pivot, or null where the two can't link.  Rows are sorted by key
    alone, which a radix sort does; those that share a key are put in order here.  They stream past, so memory does
    not depend on the size of a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in range(4)]
        pivot: list[int] | None = None  # key, node, size and pos of the first row of the large group that goes on

        def star(first, cols):
            key, node, size, pos = cols
            ok = may_link(first[2], first[3], size, pos, similar)
            keep = node != first[1]
            a = pa.array(np.broadcast_to(first[1], len(node))[keep], mask=~ok[keep])
            return pa.RecordBatch.from_arrays([pa.array(key[keep]), a, *(pa.array(c[keep]) for c in (node, size, pos))], names=["key", "a", "b", "size", "pos"])

        def ordered(cols):
            key = cols[0]
            same = key[1:] == key[:-1]
            shared = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
            if not len(shared):
                return cols
            order = shared[np.lexsort([c[shared] for c in reversed(cols)])]
            keep = np.ones(len(key), bool)
            keep[shared[1:]] = ~np.logical_and.reduce([c[order[1:]] == c[order[:-1]] for c in cols])
            for i, c in enumerate(cols):
                c = c.copy()
                c[shared] = c[order]
                cols[i] = c[keep]
            return cols

        def flush(cols):
            key = cols[0]
            if len(key) < 2:
                return
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            many = np.repeat(sizes, sizes)
            few = (many <= small) & (many > 1)
            k, n, size, pos = (c[few] for c in cols)
            found_a, found_b = [], []
            for o in range(1, int(min(small, sizes.max()))):
                if len(k) <= o:
                    break
                i = np.flatnonzero((k[o:] == k[:-o]) & (n[o:] != n[:-o]))
                i = i[may_link(size[i], pos[i], size[i + o], pos[i + o], similar)]
                found_a.append(n[i])
                found_b.append(n[i + o])
            if sum(map(len, found_a)):
                a, b = pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([none, a, b, none, none], names=["key", "a", "b", "size", "pos"])
            if (sizes > small).any():
                large = many > small
                first = [np.repeat(c[starts], sizes)[large] for c in cols]
                yield star(first, [c[large] for c in cols])

        for batch in batches:
            cols = [batch.column(i).to_numpy() if i < len(names) else np.zeros(batch.num_rows, np.int64) for i in range(4)]
            if pivot is not None:
                end = int(np.searchsorted(cols[0], pivot[0], "right"))
                if end:
                    yield star(pivot, [c[:end] for c in cols])
                if end == len(cols[0]):
                    continue
                cols, pivot = [c[end:] for c in cols], None
            cols = ordered([np.r_[h, c] for h, c in zip(held, cols, strict=True)])
            if not len(cols[0]):
                continue
            begin = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            if len(cols[0]) - begin > small:
                pivot = [c[begin] for c in cols]
                begin = len(cols[0])
            yield from flush([c[:begin] for c in cols])
            held = [c[begin:] for c in cols]
        yield from flush(held)

    names = [c for c in ("key", "node", "size", "pos") if c in rows.columns]
    rows = rows.select(*(F.col(c).cast("long").alias(c) for c in names))
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, a long, b long, size long, pos long")


def _in_two(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different components so far."""
    for side in ("a", "b"):
        home = parts.select(F.col("node").alias(side), F.col("component").alias(f"home_{side}"))
        pairs = pairs.join(home, side, "left").withColumn(f"home_{side}", F.coalesce(f"home_{side}", side))
    return pairs.where("home_a <> home_b").select("a", "b")


def linked_components(rows: DataFrame, load: Callable[[DataFrame], DataFrame], check: Callable[[DataFrame, DataFrame], DataFrame], scratch: Scratch, known: DataFrame | None = None, small: int = SMALL, similar: int = SIMILAR, finer: Callable[[DataFrame], DataFrame] | None = None, sift: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """node, component over the pairs that share a key and that are confirmed, and over ``known`` links.

    rows: as for ``bucket_pairs``; load: nodes (node) -> what is compared of them (node, ...);
    check: pairs (a, b) and that -> the pairs that are linked; finer: what is compared of the nodes of
    large keys -> their rows by other keys, more selective ones, such that each link shares one;
    sift: pairs -> those that may be linked, by less than what is loaded.  Without sift all is loaded once.

    Exact as to components: every pair that shares a key and that may link is either checked or
    already connected.  Of a large key all are checked against its pivot; then, if the key is still
    in several components, either the members of such keys go through the finer keys, or those
    outside its main component are checked against those members of others that they may link to.
    """
    made = scratch.write(bucket_pairs(rows, small, similar))
    once = scratch.write(load(made.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct())) if sift is None else None

    def linked(pairs: DataFrame, most: int | None = None) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = scratch.write(pairs.distinct() if sift is None else sift(pairs.distinct()), rows=most)
        loaded = once if sift is None else scratch.write(load(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
        found = scratch.write(check(pairs, loaded), rows=pairs.count())
        scratch.drop(pairs, None if sift is None else loaded)
        return found

    def members() -> DataFrame:
        return made.where("key is not null").select("key", F.col("b").alias("node"), "size", "pos").distinct()

    found = linked(made.where("a is not null").select("a", "b"), made.count())
    edges = found if known is None else found.unionByName(known)
    parts = connected_components(edges, scratch, edges.count())
    scratch.drop(found)
    mixed = _mixed_keys(members(), parts, scratch, made.count())
    if mixed is not None and finer is not None:
        hot = mixed.select("node").distinct()
        hot = scratch.write(load(hot) if sift else once.join(hot, "node", "left_semi"))
        scratch.drop(made, mixed)
        made = scratch.write(bucket_pairs(finer(hot), small, similar))
        parts = merged(parts, linked(_in_two(made.where("a is not null").select("a", "b").distinct(), parts), made.count()), scratch)
        scratch.drop(hot)
        mixed = _mixed_keys(members(), parts, scratch, made.count())
    if mixed is not None:
        a = mixed.where("component <> main").select("key", *(F.col(c).alias(f"a_{c}") for c in ("node", "size", "pos", "component")))
        b = mixed.select("key", *(F.col(c).alias(f"b_{c}") for c in ("node", "size", "pos", "component")))
        both = a.join(b, "key").where((F.col("a_component") != F.col("b_component")) & may_link_column("a", "b", similar))
        parts = merged(parts, linked(both.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))), scratch)
        scratch.drop(mixed)
    scratch.drop(made, once)
    return parts


def _mixed_keys(members: DataFrame, parts: DataFrame, scratch: Scratch, rows: int) -> DataFrame | None:
    """members (key, node, size, pos) of the keys that are in several components, with component and the key's main one; None if there are none.  rows: a bound of the members."""
    placed = members.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    # the largest, ties to the least component: longs only, so it is aggregated by hash
    most = sizes.groupBy("key").agg(F.max("c").alias("most"), F.count("*").alias("parts")).where("parts > 1").select("key", "most")
    mains = scratch.write(sizes.join(most, "key").where("c = most").groupBy("key").agg(F.min("component").alias("main")), rows=rows)
    if not mains.limit(1).count():
        scratch.drop(mains)
        return None
    out = scratch.write(placed.join(F.broadcast(mains) if few_enough(mains) else mains, "key"), rows=rows)
    scratch.drop(mains)
    return out
