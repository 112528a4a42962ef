"""SimHash near-duplicates by a binary trie self-join (operator 11).

A text's words (runs outside the six ASCII spaces, A-Z lower-cased) give 3-word shingles, repeats
included, joined by one space (1 or 2 words: the whole sequence is the only shingle). Each shingle
is hashed with XXH64, seed 42; bit b of the fingerprint is set if more than half of the hashes
have it set. A text without words has the fingerprint 0 and is linked like any other. Two
fingerprints are linked if they differ in at most ``BUDGET`` bits.

Distinct fingerprints are joined with themselves as binary tries. Pairs of trie nodes of equal
depth are traversed together; a pair carries the number of bits in which its two prefixes differ
and is dropped when that exceeds the budget.

* Two fingerprints within 3 bits agree in one of four 16-bit blocks, so there are four tries, the
  bits rotated so that each block comes first, and traversal starts at the equal nodes of depth 16.
* While a pair of nodes has more than ``UNIT`` members, Spark splits it by the next ``STEP`` bits
  (a join of the pairs with the child nodes' counts); a frequent block is so dealt over many tasks.
  Pairs with fewer members are units; a task traverses many units at a time in numpy.
* Within a unit the traversal runs with an error budget of 1, 2, then 3 bits. Nodes whose members
  are all known to be connected with each other are not paired again, and a unit emits a spanning
  forest, never all pairs of a dense group. Every link of different fingerprints is found or lies
  inside a connected set.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import saved
from adlytics.llm.linkage import components
from adlytics.llm.textvec import plain_strings

BUDGET = 3
BLOCK_BITS = 16
STEP = 4                 # bits by which Spark splits a pair of large nodes
UNIT = 4096              # members of a pair of nodes that one task traverses
SHINGLE = 3
SEED = 42
PIECE = 1 << 20          # bytes of a text whose words are held at a time
CHUNK = 1 << 16          # node pairs expanded at a time
ROWS = 1 << 16           # members traversed together, at least
_U = np.uint64


def word_lists(text: bytes):
    """The words of ``text`` in lists, each of a piece of it that ends at a space."""
    if len(text) <= PIECE:
        yield text.lower().split()
        return
    i = 0
    while i < len(text):
        j = i + PIECE
        while j < len(text) and text[j] not in b" \t\n\v\f\r":
            j += 1
        yield text[i:j].lower().split()
        i = j


def bit_counts(words: list[bytes], width: int) -> np.ndarray:
    """How many of the hashes of the ``width``-word shingles of ``words`` have each bit set."""
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[:len(words) - width + 1].tolist()
    hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start, end[width - 1:].tolist())]
    raw = np.array(hashes, _U).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def simhash(text: bytes) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    ones, n, held = np.zeros(64, np.int64), 0, []
    for words in word_lists(text):
        held += words
        if len(held) >= SHINGLE:
            ones += bit_counts(held, SHINGLE)
            n += len(held) - SHINGLE + 1
            held = held[1 - SHINGLE:]
    if n == 0 and held:
        ones, n = bit_counts(held, len(held)), 1
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; a null text is empty. ``fp`` holds the 64 bits as a long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts = plain_strings(batch.column("text")).cast(pa.large_binary())
            fp = np.array([simhash(t.as_py()) for t in texts], _U)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def joined_sets(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels 0..n-1 of the sets that ``label`` and the links a[i] - b[i] make; the label of a set
    is its smallest member."""
    label = label.copy()
    while True:
        x, y = label[a], label[b]
        low = np.minimum(x, y)
        before = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            return label


class TrieJoin:
    """Traverses pairs of nodes over ``bits``, sorted within each node; a node is a range of it."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.n = bits, len(bits)
        self.ones: dict[int, np.ndarray] = {}
        self.relabel(np.arange(self.n))

    def relabel(self, label):
        self.label = label
        change = np.zeros(self.n, np.int32)
        change[1:] = np.cumsum(label[1:] != label[:-1])
        self.change = change

    def ones_before(self, depth):
        if depth not in self.ones:
            bit = (self.bits >> _U(63 - depth)) & _U(1)
            self.ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)])
        return self.ones[depth]

    def open_pairs(self, p):
        """The pairs (columns: a0, a1, b0, b1, differing bits) not known to be connected as a whole."""
        a0, a1, b0, b1 = p[0], p[1] - 1, p[2], p[3] - 1
        c, label = self.change, self.label
        known = (c[a0] == c[a1]) & (c[b0] == c[b1]) & (label[a0] == label[b0])
        return p[:, ~known]

    def children(self, p, depth, budget):
        ones = self.ones_before(depth)
        a0, a1, b0, b1, d = p
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = (a0 == b0) & (a1 == b1)
        out = []
        for x0, x1, y0, y1, cost, keep in ((a0, am, b0, bm, 0, None), (am, a1, bm, b1, 0, None),
                                           (a0, am, bm, b1, 1, None), (am, a1, b0, bm, 1, ~same)):
            ok = (x0 < x1) & (y0 < y1) & (d + cost <= budget)
            if keep is not None:
                ok &= keep
            out.append(np.stack([x0[ok], x1[ok], y0[ok], y1[ok], d[ok] + cost]))
        return np.concatenate(out, axis=1)

    def links(self, roots, budget):
        """Labels after all links of at most ``budget`` bits under ``roots``: (depth, pairs)."""
        stack, found, n_found = list(roots), [], 0

        def merge():
            a, b = np.concatenate(found, axis=1)
            self.relabel(joined_sets(self.n, a, b, self.label))
            found.clear()

        while stack:
            depth, p = stack.pop()
            p = self.open_pairs(p)
            if p.shape[1] > CHUNK:
                stack += [(depth, p[:, i:i + CHUNK]) for i in range(0, p.shape[1], CHUNK)]
                continue
            single = (p[1] - p[0] == 1) & (p[3] - p[2] == 1)
            a, b = p[0][single], p[2][single]
            near = np.bitwise_count(self.bits[a] ^ self.bits[b]) <= budget
            if near.any():
                found.append(np.stack([a[near], b[near]]))
                n_found += int(near.sum())
            p = p[:, ~single]
            if p.shape[1]:
                stack.append((depth + 1, self.children(p, depth, budget)))
            if n_found > CHUNK:
                merge()
                n_found = 0
        if found:
            merge()

    def spanning(self, roots, budget):
        """(member, member) links whose connected sets are those of all links under ``roots``."""
        for e in range(1, budget + 1):
            self.links([(depth, p[:, p[4] <= e]) for depth, p in roots], e)
        own = np.flatnonzero(self.label != np.arange(self.n))
        return own, self.label[own]


def rotated(fp: Column, block: Column) -> Column:
    """The bits of ``fp`` rotated left by ``block`` blocks, so that this block comes first."""
    by = block * BLOCK_BITS
    return F.when(block == 0, fp).otherwise(
        F.call_function("shiftleft", fp, by).bitwiseOR(F.call_function("shiftrightunsigned", fp, 64 - by)))


def prefix(bits: Column, depth: int) -> Column:
    return F.call_function("shiftrightunsigned", bits, F.lit(64 - depth))


def trie_units(rows: DataFrame, unit: int, budget: int = BUDGET) -> list[tuple[int, DataFrame]]:
    """Per depth, the pairs of nodes (block, u, v, d) of that depth to be traversed by tasks.

    ``rows`` (block, bits): the members of the tries. ``d``: bits in which the prefixes u <= v
    differ. Counts per node are the only state; pairs that are too large go on to their children.
    """
    depth = BLOCK_BITS
    nodes = rows.groupBy("block", prefix(F.col("bits"), depth).alias("u")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = saved(nodes.select("block", "u", F.col("u").alias("v"), F.lit(0).alias("d"), "n"))
    out = []
    while True:
        out.append((depth, pairs.filter(F.col("n") <= unit).drop("n")))
        large = pairs.filter(F.col("n") > unit)
        if depth == 64 or large.isEmpty():
            return out
        split = large.select("block", F.col("u").alias("p")).union(large.select("block", F.col("v").alias("p"))).distinct()
        low = depth + STEP
        child = saved(rows.withColumn("p", prefix(F.col("bits"), depth)).join(split, ["block", "p"])
                      .groupBy("block", "p", prefix(F.col("bits"), low).alias("c")).agg(F.count(F.lit(1)).alias("n")))
        left = child.select("block", F.col("p").alias("u"), F.col("c").alias("cu"), F.col("n").alias("nu"))
        right = child.select("block", F.col("p").alias("v"), F.col("c").alias("cv"), F.col("n").alias("nv"))
        d = F.col("d") + F.bit_count(F.col("cu").bitwiseXOR(F.col("cv")).bitwiseAND(F.lit((1 << STEP) - 1)))
        pairs = large.drop("n").join(left, ["block", "u"]).join(right, ["block", "v"]) \
            .withColumn("d", d).filter(F.col("d") <= budget).filter("u <> v OR cu <= cv") \
            .withColumn("n", F.when(F.col("cu") == F.col("cv"), F.col("nu")).otherwise(F.col("nu") + F.col("nv"))) \
            .filter("n > 1").select("block", F.col("cu").alias("u"), F.col("cv").alias("v"), "d", "n")
        pairs, depth = saved(pairs), low


def unit_links(members: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(a, b): links between fingerprints that span each unit's connected sets.

    ``members`` (block, depth, u, v, d, bits), both nodes' members of each unit; at most ``UNIT``
    rows a unit, so many units are held, and traversed, together.
    """
    unit = ["block", "depth", "u", "v"]
    ordered = members.repartition(*unit).sortWithinPartitions(*unit, "bits")

    def traverse(t):
        block, depth, u, v, d = (t.column(c).to_numpy() for c in ("block", "depth", "u", "v", "d"))
        bits = t.column("bits").to_numpy().view(_U)
        new = np.ones(len(bits), bool)
        new[1:] = (block[1:] != block[:-1]) | (depth[1:] != depth[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(bits))
        order = np.lexsort((bits, np.cumsum(new)))
        bits, block = bits[order], block[order]
        # in unsigned order the members of one node come first, then those of the other
        node = bits >> (64 - depth).astype(_U)
        first = node == np.repeat(node[start], end - start)
        middle = start + np.add.reduceat(first.astype(np.int64), start)
        roots = []
        for low in np.unique(depth):
            s = depth[start] == low
            same = s & (u[start] == v[start])
            pair = s & (u[start] != v[start])
            zero = np.zeros(int(same.sum()), np.int64)
            whole = np.stack([start[same], end[same], start[same], end[same], zero])
            cross = np.stack([start[pair], middle[pair], middle[pair], end[pair], d[start[pair]].astype(np.int64)])
            roots.append((int(low), np.concatenate([whole, cross], axis=1)))
        a, b = TrieJoin(bits).spanning(roots, budget)
        back = [(x >> (_U(BLOCK_BITS) * block[i].astype(_U))) | np.where(
            block[i] == 0, _U(0), x << ((_U(64) - _U(BLOCK_BITS) * block[i].astype(_U)) & _U(63)))
            for i, x in ((a, bits[a]), (b, bits[b]))]
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in back], names=["a", "b"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n < ROWS:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            key = [t.column(c).to_numpy() for c in unit]
            last = np.flatnonzero(reduce(np.logical_or, [k[1:] != k[:-1] for k in key]))
            if len(last):                               # the last unit may go on in the next batch
                yield traverse(t.slice(0, int(last[-1]) + 1))
                t = t.slice(int(last[-1]) + 1)
            held, n = t.to_batches(), len(t)
        if n:
            yield traverse(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, "a long, b long")


def near_links(fingerprints: DataFrame, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """(a, b) links of the distinct fingerprints ``fp``; their connected sets are those of all
    pairs that differ in at most ``budget`` (0 to 3) bits."""
    if not 0 <= budget <= 64 // BLOCK_BITS - 1:
        raise ValueError("fingerprints of more differing bits may share no block")
    rows = fingerprints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64 // BLOCK_BITS - 1))).alias("block")) \
        .select("block", rotated(F.col("fp"), F.col("block")).alias("bits"))
    members = []
    for depth, pairs in trie_units(rows, unit, budget):
        ends = F.when(F.col("u") == F.col("v"), F.array("u")).otherwise(F.array("u", "v"))
        nodes = pairs.withColumn("p", F.explode(ends))
        members.append(rows.withColumn("p", prefix(F.col("bits"), depth)).join(nodes, ["block", "p"])
                       .select("block", F.lit(depth).alias("depth"), "u", "v", "d", "bits"))
    return unit_links(reduce(DataFrame.union, members), budget)


def near_duplicates(docs: DataFrame, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_copies), one row per row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links, the own one included;
    ``n_copies`` counts the rows of the same fingerprint. A null or empty text, or one without
    words, has the fingerprint 0. Rows with a null doc_id take part like others; a component of
    such rows alone has a null component_id. Repeated rows are each returned; an empty table
    gives no rows; other columns of ``docs`` are not read.
    """
    signed = saved(fingerprint_rows(docs))
    nodes = saved(signed.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies")))
    links = saved(near_links(nodes.select("fp"), budget, unit))
    label = components(links)
    own = nodes.join(label.withColumnRenamed("id", "fp"), "fp", "left") \
        .select("fp", "first_id", "n_copies", F.coalesce("label", "fp").alias("label"))
    ids = own.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = own.join(ids, "label").select("fp", "n_copies", "component_id")
    return signed.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_copies")
