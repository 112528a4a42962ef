"""From band keys to classes of near copies: candidates, verified links, connected components.

Used by both signature operators. Nodes are distinct texts (exact copies are folded before).
A node meets others through equal band keys; a bucket's pairs are never listed:

1. Each bucket's members are compared with its hub, the member that shares most bands with
   others (so the common original of a group of edited copies). Members linked to the same hub
   are in one class. The members that are not ("free") are compared with a second hub of their own.
2. A free member x can still be linked to another member y. What x and y share lies inside the
   hub's shingles or beyond them, so with hx, hy the overlaps of x, y with the hub

       overlap(x, y) <= min(hx, hy) + common shingles of x and y beyond the hub,

   and a similarity of t needs an overlap of at least t / (1 + t) * (|x| + |y|) >= t * max(|x|, |y|).
   So either min(hx, hy) is that large by itself, which bounds |y| by x's own numbers (a join on
   hub and size class), or x and y share so many shingles beyond the hub that, in any order, one
   shared is among the first of both (a prefix-filter join). In ascending order of how many
   members have it, the shingles that only x has come first and match nothing.

No link between two texts that share a band is lost.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import saved
from adlytics.llm.textvec import WordHasher, blocks, mix, multisets, plain_strings, text_shingles

SIZE_STEP = 1.05         # ratio of neighbouring size classes
_U = np.uint64
_MASK = _U((1 << 44) - 1)


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(hub, id, th, tx): both texts joined to each pair; skewed hubs are split by AQE."""
    tx = texts.select("id", F.col("text").alias("tx"))
    th = texts.select(F.col("id").alias("hub"), F.col("text").alias("th"))
    return pairs.join(tx, "id").join(th, "hub").select("hub", "id", "th", "tx")


def compared(pairs: DataFrame, texts: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    """(hub, id, linked, size, inside, beyond) of pairs (hub, id): whether the overlap of their
    shingles reaches the threshold, the size of id's text, its overlap with the hub's, and its
    shingles beyond it (of a multiset, each further copy counts as one more)."""

    def check(batches):
        hasher = WordHasher()
        for batch in batches:
            h, x = plain_strings(batch.column("th")), plain_strings(batch.column("tx"))
            for i, j in blocks(x):
                n = j - i
                (kh, ch), (kx, cx) = (multisets(*text_shingles(t[i:j], hasher)) for t in (h, x))
                if not weighted:
                    ch, cx = np.ones_like(ch), np.ones_like(cx)
                at = np.searchsorted(kh, kx)
                hit = at < len(kh)
                hit[hit] = kh[at[hit]] == kx[hit]
                both = np.zeros(len(kx), np.int64)
                both[hit] = np.minimum(ch[at[hit]], cx[hit])
                of = (kx >> _U(44)).astype(np.int64)
                inside = np.bincount(of, weights=both, minlength=n).astype(np.int64)
                size = np.bincount(of, weights=cx, minlength=n).astype(np.int64)
                hub_size = np.bincount((kh >> _U(44)).astype(np.int64), weights=ch, minlength=n)
                linked = inside >= threshold * (size + hub_size - inside) - 1e-9
                linked &= size > 0
                extra = cx - both
                row = np.repeat(np.arange(len(kx)), extra)
                copy = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
                h44 = mix((kx[row] & _MASK) + copy.astype(_U) * _U(0x9E3779B97F4A7C15)) >> _U(20)
                off = np.concatenate([[0], np.cumsum(np.bincount(of[row], minlength=n))]).astype(np.int32)
                beyond = pa.ListArray.from_arrays(pa.array(off), pa.array(h44.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("hub")[i:j], batch.column("id")[i:j], pa.array(linked), pa.array(size), pa.array(inside),
                     beyond], names=["hub", "id", "linked", "size", "inside", "beyond"])

    return with_texts(pairs, texts).mapInArrow(
        check, "hub string, id string, linked boolean, size long, inside long, beyond array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every node of the undirected edges (a, b); label = smallest id reachable.

    Each pass takes the smallest label among the neighbours, then follows the label of that
    label, so long chains shorten quickly; each pass is a checkpoint, the driver sees one count.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = saved(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("id"), F.least("a", "m").alias("label")))
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("m")).select(F.col("a").alias("id"), "m"))
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        far = step.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = saved(step.join(far, "label").select("id", "old", F.least("label", "next").alias("label")))
        labels = new.select("id", "label")
        if new.filter("label <> old").isEmpty():
            return labels


def hub_pairs(members: DataFrame) -> DataFrame:
    """Distinct (hub, id) of members (key, id, score) of one bucket, the hub left out."""
    hubs = members.groupBy("key").agg(F.max(F.struct("score", F.col("id").alias("hub"))).alias("h")).select("key", "h.hub")
    return members.join(hubs, "key").filter("id <> hub").select("hub", "id").distinct()


def rest_pairs(first: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Distinct (hub, id), hub < id, of the pairs that may still be linked (see the module's text).

    ``first``: the comparisons with the buckets' hubs; ``labels`` (id, label): what is known to be
    linked, two nodes of equal label need no comparison.
    """
    open_hubs = first.filter("NOT linked").select("hub").distinct()
    at = saved(first.filter("size > 0").join(open_hubs, "hub").join(labels, "id", "left").select(
        "hub", "id", F.coalesce("label", "id").alias("label"), "linked", "size", "inside", F.size("beyond").alias("extra"), "beyond"))
    need = threshold / (1 + threshold)

    def sides(left, right, key, condition):
        x = left.select(*[F.col(c).alias(f"x_{c}") for c in left.columns])
        y = right.select(*[F.col(c).alias(f"y_{c}") for c in right.columns])
        on = " AND ".join(f"x_{c} = y_{c}" for c in key)
        return x.join(y, F.expr(f"{on} AND x_id <> y_id AND x_label <> y_label AND {condition}")) \
            .select(F.least("x_id", "y_id").alias("hub"), F.greatest("x_id", "y_id").alias("id"))

    # shingles beyond the hub that members of different labels have, one of them free
    element = at.select("hub", "id", "label", "linked", F.explode("beyond").alias("e")) \
        .select("hub", "id", "label", "linked", F.xxhash64("hub", "e").alias("key"))
    common = element.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("linked").alias("linked"),
                                        F.min("label").alias("lo"), F.max("label").alias("hi")) \
        .filter("lo <> hi AND NOT linked").select("key", "n")
    lists = element.select("hub", "id", "key").join(common, "key").groupBy("hub", "id") \
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("list"))
    # the place of an element counts the ones before that match nothing
    least_common = F.greatest(F.lit(1), F.ceil(F.col("size") * threshold - F.col("inside") - 1e-6))
    prefix = at.drop("beyond").join(lists, ["hub", "id"]) \
        .withColumn("alone", F.col("extra") - F.size("list")) \
        .withColumn("take", (F.col("extra") - least_common + 1 - F.col("alone")).cast("int")).filter("take > 0") \
        .select("id", "label", "linked", "size", "inside", "extra", "alone",
                F.posexplode(F.slice("list", F.lit(1), F.col("take"))).alias("pos", "s")) \
        .select("id", "label", "linked", "size", "inside", "extra", (F.col("alone") + F.col("pos")).alias("place"), "s.key")
    prefix = saved(prefix)
    wanted = f"greatest(1, ceil({need} * (x_size + y_size) - least(x_inside, y_inside) - 1e-6))"
    shared = sides(prefix.filter("NOT linked"), prefix, ("key",),
                   f"x_place <= x_extra - {wanted} AND y_place <= y_extra - {wanted} "
                   f"AND least(x_size, y_size) >= {threshold} * greatest(x_size, y_size) - 1e-6")

    size_class = lambda c: F.floor(F.log(c.cast("double")) / F.log(F.lit(SIZE_STEP)))
    ranged = at.filter("NOT linked").withColumn("lo", F.col("size") * threshold) \
        .withColumn("hi", F.col("inside") / need - F.col("size")).filter("hi >= lo - 1e-6") \
        .withColumn("class", F.explode(F.sequence(size_class(F.col("lo")) - 1, size_class(F.greatest("lo", "hi")) + 1)))
    contained = sides(ranged.select("hub", "id", "label", "size", "inside", "class"),
                      at.select("hub", "id", "label", "size", "inside", size_class(F.col("size")).alias("class")),
                      ("hub", "class"), f"least(x_inside, y_inside) >= {need} * (x_size + y_size) - 1e-6")
    return shared.union(contained).distinct()


def near_classes(bands: DataFrame, texts_of, threshold: float, weighted: bool) -> DataFrame:
    """(id, label) of the nodes that have a verified near copy; other nodes are absent.

    ``bands`` (id string, bands array<long>): equal elements at one position are a collision.
    ``texts_of(wanted)`` gives (id, text) of the nodes in ``wanted`` (id); it is asked once, for
    the nodes that share a band key with another.
    """
    keys = bands.select("id", F.posexplode("bands").alias("pos", "value")) \
        .select("id", F.xxhash64("pos", "value").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = saved(keys.join(shared, "key"))
    score = members.groupBy("id").agg(F.sum("n").alias("score"))
    members = saved(members.drop("n").join(score, "id"))
    texts = saved(texts_of(members.select("id").distinct()))

    def classes(*found):
        links = reduce(DataFrame.union, [f.select("hub", "id", "linked") for f in found]).filter("linked")
        return components(links.select(F.col("hub").alias("a"), F.col("id").alias("b")))

    first = saved(compared(hub_pairs(members), texts, threshold, weighted))
    free = members.join(first.filter("NOT linked").select("id").distinct(), "id")
    seen = first.select("hub", "id").union(first.select(F.col("id").alias("hub"), F.col("hub").alias("id")))
    second = saved(compared(hub_pairs(free).join(seen, ["hub", "id"], "left_anti"), texts, threshold, weighted)
                   .select("hub", "id", "linked"))
    labels = classes(first, second)
    rest = rest_pairs(first, labels, threshold).join(seen, ["hub", "id"], "left_anti")
    third = saved(compared(rest, texts, threshold, weighted).select("hub", "id", "linked"))
    return labels if third.filter("linked").isEmpty() else classes(first, second, third)
