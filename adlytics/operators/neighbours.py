"""Exact nearest neighbours over tables of any width, with missing coordinates.

Distance is the NaN-Euclidean one: over the coordinates present in both rows,
    dist = sqrt(n / m * sum (a_j - b_j)^2),   n = all coordinates, m = shared coordinates,
undefined (no donor) when nothing is shared.

Search without a cross join and without capping donors. Every row gets one or more keys:

* a *pivot* key, if some coordinates are never missing: the distances, over those coordinates, to
  two reference points (corners of the donors' value ranges). By the triangle inequality they
  differ between two rows by no more than the rows' distance.
* a *coordinate* key per present coordinate that spreads wider than the pivot key (all of them
  without a pivot key). Of a pair's keys only the first shared one counts, widest spread first, so
  a pair is met once, whatever the two rows lack.

Pivot keys are cut into cells of width eps, each coordinate into cells of its own that hold about
as many donors; queries meet donors of the neighbouring cells by an equi-join. That finds every
donor within some radius of the query (eps, and the distance to the first cells of a coordinate
that were left out), so a query whose k-th distance is inside it is settled. Of the others that
distance is a bound on their answer's: the next round takes them to the cells of each coordinate
it reaches, or to 4 x as many where fewer than k donors were found, and to wider pivot cells, until
the cells cover all values.

A cell's queries and donors are dealt in blocks of at most about ``QUERY_BLOCK`` x ``DONOR_BLOCK``
rows, so a crowded cell is spread over many tasks. A block is one matrix product in numpy; the
distances of the rows that can be among the k nearest are then taken again coordinate by
coordinate, left to right, and ranked by (distance, donor id).
"""

from __future__ import annotations

import math
import sys
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

from adlytics.functions.exprs import col
from adlytics.session import cut_lineage

QUERY_BLOCK, DONOR_BLOCK = 512, 2048
CELL_ROWS = 1024          # donors a pivot cell holds in the first round, on average; a coordinate's cell a quarter
MOST_CUTS = 1 << 20       # cuts between the cells of all coordinates together
REST_PAIRS = 1 << 25      # comparisons of the queries left that one last round may take
CELL = ["kappa", "b1", "b2"]
BLOCK = [*CELL, "qc", "dc"]
CELLS_EACH = 8            # cells of a coordinate that a query looks into
OUT_ROWS = 10000          # rows of a batch that a task hands on

# tasks get the functions themselves, not an import of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matrix(column, n: int) -> np.ndarray:
    """Rows x n doubles of a list column; a missing coordinate is NaN."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n)


def profile(rows: DataFrame, n: int) -> list:
    """Per coordinate (j, missing, lo, hi, spread): one pass, one partial row per task and coordinate."""
    def run(batches):
        miss, lo, hi = np.zeros(n, np.int64), np.full(n, np.inf), np.full(n, -np.inf)
        count, s, ss = np.zeros(n), np.zeros(n), np.zeros(n)
        for batch in batches:
            v = matrix(batch.column("v"), n)
            gone = np.isnan(v)
            miss += gone.sum(axis=0)
            lo, hi = np.fmin(lo, np.fmin.reduce(v, axis=0, initial=np.inf)), np.fmax(hi, np.fmax.reduce(v, axis=0, initial=-np.inf))
            z = np.where(gone, 0.0, v)
            count, s, ss = count + (~gone).sum(axis=0), s + z.sum(axis=0), ss + (z * z).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.arange(n), miss, lo, hi, count, s, ss)],
                                         names=["j", "miss", "lo", "hi", "count", "s", "ss"])

    part = rows.select("v").mapInArrow(run, "j long, miss long, lo double, hi double, count double, s double, ss double")
    mean = F.try_divide(F.sum("s"), F.sum("count"))
    return part.groupBy("j").agg(
        F.sum("miss").alias("miss"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.sum("ss"), F.sum("count")) - mean * mean)).alias("spread")) \
        .orderBy("j").collect()


class KeyPlan:
    """Which keys rows get: coordinates, widest first, then the pivot distances."""

    def __init__(self, donors: list, queries: list):
        n = len(donors)
        self.n = n
        lo = np.array([r["lo"] for r in donors], float)
        hi = np.array([r["hi"] for r in donors], float)
        spread = np.array([r["spread"] or 0.0 for r in donors], float)
        complete = np.array([d["miss"] == 0 and q["miss"] == 0 and math.isfinite(d["lo"]) for d, q in zip(donors, queries)], bool)
        self.complete = np.flatnonzero(complete)
        by_spread = sorted(range(n), key=lambda j: (-spread[j], j))
        if len(self.complete):
            order = [j for j in by_spread if complete[j]]
            low, far = lo.copy(), lo.copy()
            far[order[1::2]] = hi[order[1::2]]           # the second corner alternates by spread
            self.pivots = np.stack([low[self.complete], far[self.complete]])
            pivot_spread = spread[order[0]]
            self.coordinates = [j for j in by_spread if not complete[j] and spread[j] > pivot_spread and math.isfinite(lo[j])]
        else:
            self.pivots = None
            self.coordinates = [j for j in by_spread if math.isfinite(lo[j])]
        both = [(min(d["lo"], q["lo"]), max(d["hi"], q["hi"])) for d, q in zip(donors, queries)]
        width = [b - a if math.isfinite(b - a) else 0.0 for a, b in both]
        # a distance to a corner is at most that over the whole box of values
        self.range = max(1e-12, 2 * math.sqrt(sum(width[j] ** 2 for j in self.complete)))
        self.given = np.isfinite(lo)                     # coordinates that some donor has
        self.cuts = [np.zeros(0) for _ in self.coordinates]

    def cut(self, donors: DataFrame, n_donors: int):
        """Cells of about as many donors for every coordinate with a key."""
        cells = min(-(-4 * n_donors // CELL_ROWS), MOST_CUTS // max(1, len(self.coordinates)))
        if cells < 2 or not self.coordinates:
            return
        at = F.array(*[F.lit(i / cells) for i in range(1, cells)])
        rows = with_keys(donors.select("v"), self).filter(F.col("kappa") < len(self.coordinates))
        for r in rows.groupBy("kappa").agg(F.percentile_approx("x1", at, 4 * cells).alias("cuts")).collect():   # one row per key
            self.cuts[r["kappa"]] = np.unique(np.array(r["cuts"], float))

    @property
    def cells(self) -> int:
        """Cells of the coordinate that has most."""
        return max([len(c) + 1 for c in self.cuts], default=1)

    def keys(self, v: np.ndarray):
        """(key number, rows, x1, x2) of each kind of key of the rows ``v``."""
        for kappa, j in enumerate(self.coordinates):
            rows = np.flatnonzero(~np.isnan(v[:, j]))
            yield kappa, rows, v[rows, j], np.zeros(len(rows))
        if self.pivots is not None:
            part = v[:, self.complete]
            d = [np.sqrt(((part - p) ** 2).sum(axis=1)) for p in self.pivots]
            yield len(self.coordinates), np.arange(len(v)), d[0], d[1]


def with_keys(rows: DataFrame, plan: KeyPlan) -> DataFrame:
    """``rows`` once per key, with kappa, x1, x2 and the coordinate's cell c1."""
    names = rows.columns

    def run(batches):
        for batch in batches:
            v = matrix(batch.column("v"), plan.n)
            for kappa, at, x1, x2 in plan.keys(v):
                if len(at):
                    part = batch.take(pa.array(at))
                    c1 = np.searchsorted(plan.cuts[kappa], x1, "right") if kappa < len(plan.cuts) else np.zeros(len(at), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(np.full(len(at), kappa, np.int32)), pa.array(x1), pa.array(x2), pa.array(c1)],
                        names=[*names, "kappa", "x1", "x2", "c1"])

    schema = StructType(list(rows.schema.fields)).add("kappa", IntegerType()).add("x1", DoubleType()).add("x2", DoubleType()) \
        .add("c1", LongType())
    return rows.mapInArrow(run, schema)


def searchable(queries: DataFrame, plan: KeyPlan, slots: str | None) -> DataFrame:
    """The queries that can have an answer: with a key and, with a slot per missing coordinate, one
    that some donor has."""
    def run(batches):
        for batch in batches:
            gone = np.isnan(matrix(batch.column("v"), plan.n))
            keep = np.ones(len(gone), bool) if plan.pivots is not None else (~gone[:, plan.coordinates]).any(axis=1)
            if slots == "missing":
                keep &= gone[:, plan.given].any(axis=1)
            yield batch.filter(pa.array(keep))
    return queries.mapInArrow(run, queries.schema)


def fine_cells(plan: KeyPlan, v: np.ndarray, reach: np.ndarray, span: int):
    """(key number, rows, x1, first cell, last cell, gain) of the cells of each coordinate that queries
    look into: ``span`` to either side, or as far as ``reach`` where it is known.

    Two rows that share a coordinate, but none of the earlier keys of the query, share at most its
    other coordinates: their distance is at least ``gain`` times their difference."""
    present, earlier = (~np.isnan(v)).sum(axis=1), np.zeros(len(v), np.int64)
    for kappa, at, x1, _ in plan.keys(v):
        if kappa < len(plan.cuts):
            cuts = plan.cuts[kappa]
            gain = np.sqrt(plan.n / (present[at] - earlier[at]))
            earlier[at] += 1
            need = reach[at] / gain * (1 + 1e-8) + 1e-15 * np.abs(x1)
            known = np.isfinite(need)
            low, high = (np.searchsorted(cuts, np.where(known, x, x1), "right") for x in (x1 - need, x1 + need))
            yield (kappa, at, x1, np.where(known, low, np.maximum(low - span, 0)),
                   np.where(known, high, np.minimum(high + span, len(cuts))), gain)


def merged(pending: DataFrame, plan: KeyPlan, span: int) -> int:
    """How often cells are merged by twos in a round, so that most queries look into few of a coordinate."""
    def run(batches):
        for batch in batches:
            v = matrix(batch.column("v"), plan.n)
            reach = batch.column("reach").to_numpy(zero_copy_only=False).astype(float)
            n, keys = np.zeros(len(v)), np.zeros(len(v))
            for _, at, _, low, high, _ in fine_cells(plan, v, reach, span):
                n[at] += high - low + 1
                keys[at] += 1
            yield pa.RecordBatch.from_arrays([pa.array(n / np.maximum(keys, 1))], names=["n"])
    many = pending.select("v", "reach").mapInArrow(run, "n double").agg(F.percentile_approx("n", 0.9)).first()[0]
    return max(0, math.ceil(math.log2((many or 1) / CELLS_EACH)))


def placed(queries: DataFrame, plan: KeyPlan, eps: float, span: int, merge: int) -> DataFrame:
    """The queries once per cell they look into, with its kappa, b1, b2 and ``radius``: donors that are
    not in the cells of a query are at least so far from it.

    A query looks into the cells of ``fine_cells``, 2 ** ``merge`` of them taken as one, and into the pivot
    cells around its own."""
    names = [c for c in queries.columns if c != "reach"]

    def run(batches):
        for batch in batches:
            v = matrix(batch.column("v"), plan.n)
            reach = batch.column("reach").to_numpy(zero_copy_only=False).astype(float)
            radius, found = np.full(len(v), np.inf), []
            for kappa, at, x1, low, high, gain in fine_cells(plan, v, reach, span):
                far = np.r_[-np.inf, plan.cuts[kappa], np.inf]       # cell c is from far[c] up to far[c + 1]
                low, high = low >> merge, high >> merge
                after = np.minimum((high + 1) << merge, len(far) - 1)
                r = np.minimum(x1 - far[low << merge], far[after] - x1) * gain * (1 - 1e-9)
                radius[at] = np.minimum(radius[at], r)
                count = high - low + 1
                b1 = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                found.append((kappa, np.repeat(at, count), b1, np.zeros(len(b1), np.int64)))
            for kappa, at, x1, x2 in plan.keys(v):
                if kappa == len(plan.cuts):
                    radius[at] = np.minimum(radius[at], eps * (1 - 1e-9))
                    b1, b2 = (np.repeat(np.floor(x / eps).astype(np.int64), 9) + np.tile(s, len(at))
                              for x, s in ((x1, np.repeat([-1, 0, 1], 3)), (x2, np.tile([-1, 0, 1], 3))))
                    found.append((kappa, np.repeat(at, 9), b1, b2))
            plain = batch.select(names)
            for kappa, rows, b1, b2 in found:
                for i in range(0, len(rows), OUT_ROWS):
                    part = slice(i, i + OUT_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [*plain.take(pa.array(rows[part])).columns, pa.array(np.full(len(rows[part]), kappa, np.int32)),
                         pa.array(b1[part]), pa.array(b2[part]), pa.array(radius[rows[part]])], names=[*names, *CELL, "radius"])

    schema = StructType([queries.schema[c] for c in names]).add("kappa", IntegerType()).add("b1", LongType()) \
        .add("b2", LongType()).add("radius", DoubleType())
    return queries.mapInArrow(run, schema)


def dealt(q: DataFrame, donors: DataFrame, eps: float, pivot_kappa: int, merge: int):
    """Placed queries and donors with the block they meet in (``BLOCK``): cells, and in a cell a grid
    of query parts x donor parts."""
    def cell(x, otherwise):
        return F.when(F.col("kappa") == pivot_kappa, F.floor(F.col(x) / F.lit(eps)).cast("long")).otherwise(otherwise)
    d = donors.withColumn("b1", cell("x1", F.shiftright("c1", merge))).withColumn("b2", cell("x2", F.lit(0).cast("long"))).drop("x1", "x2", "c1")
    size = d.groupBy(*CELL).agg(F.count(F.lit(1)).alias("nd")) \
        .join(q.groupBy(*CELL).agg(F.count(F.lit(1)).alias("nq")), CELL)
    grid = size.select(*CELL, F.ceil(F.col("nd") / DONOR_BLOCK).alias("nd"), F.ceil(F.col("nq") / QUERY_BLOCK).alias("nq"))
    zero = F.lit(0).cast("long")
    d = d.join(grid, CELL).withColumn("dc", F.pmod(F.xxhash64("did"), F.col("nd"))) \
        .withColumn("qc", F.explode(F.sequence(zero, F.col("nq") - 1))).drop("nd", "nq")
    q = q.join(grid, CELL).withColumn("qc", F.pmod(F.xxhash64("qid"), F.col("nq"))) \
        .withColumn("dc", F.explode(F.sequence(zero, F.col("nd") - 1))).drop("nd", "nq")
    return q, d


class BlockSearch:
    """The nearest donors of a block of queries, per slot."""

    def __init__(self, plan: KeyPlan, k: int, slots: str | None, exclude_self: bool, apart: bool):
        self.plan, self.k, self.slots, self.exclude_self, self.apart = plan, k, slots, exclude_self, apart

    def __call__(self, q: pa.Table, d: pa.Table):
        """(query rows, slots, donor rows, distances)."""
        n = self.plan.n
        a, b = matrix(q.column("v"), n), matrix(d.column("v"), n)
        ma, mb = ~np.isnan(a), ~np.isnan(b)
        shift = np.where(mb.any(axis=0), np.nansum(b, axis=0) / np.maximum(mb.sum(axis=0), 1), 0.0)
        za, zb = np.where(ma, a - shift, 0.0), np.where(mb, b - shift, 0.0)
        fa, fb = ma.astype(float), mb.astype(float)
        shared = fa @ fb.T
        left, right = (za * za) @ fb.T, fa @ (zb * zb).T
        gain = np.where(shared > 0, n / np.maximum(shared, 1), np.inf)
        square = (left + right - 2 * (za @ zb.T)) * np.where(np.isfinite(gain), gain, 0.0)
        slack = 1e-11 * (left + right) * np.where(np.isfinite(gain), gain, 0.0) + 1e-280
        ok = shared > 0
        kappa = q.column("kappa")[0].as_py()
        before = self.plan.coordinates[:kappa]
        if before:                                       # met by an earlier key already
            ok &= (fa[:, before] @ fb[:, before].T) == 0
        if self.exclude_self:
            ok &= q.column("qid").to_numpy()[:, None] != d.column("did").to_numpy()[None, :]
        if self.apart:
            ok &= q.column("qpart").to_numpy()[:, None] != d.column("dpart").to_numpy()[None, :]
        upper, lower = np.where(ok, square + slack, np.inf), np.where(ok, square - slack, np.inf)
        out = []
        for slot, rows, donors in self.slot_sets(ma, mb, d):
            if len(rows) and len(donors):
                up = upper[np.ix_(rows, donors)]
                kth = np.partition(up, self.k - 1, axis=1)[:, self.k - 1] if up.shape[1] > self.k else np.full(len(rows), np.inf)
                i, j = np.nonzero((lower[np.ix_(rows, donors)] <= kth[:, None]) & np.isfinite(up))
                out.append((rows[i], np.full(len(i), slot, np.int64), donors[j]))
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z, np.zeros(0)
        i, slot, j = (np.concatenate(x) for x in zip(*out))
        total = np.zeros(len(i))
        for c in range(n):                               # left to right, as a sum of columns
            x = (a[i, c] - b[j, c]) ** 2
            total = total + np.where(np.isnan(x), 0.0, x)
        dist = np.sqrt(n / shared[i, j] * total)
        best = self.first_k(i, slot, j, dist, d)
        return i[best], slot[best], j[best], dist[best]

    def first_k(self, i, slot, j, dist, d):
        """The places of the k first donors per query and slot: of donors at one distance, as copies
        are, no more than k can be among the k nearest."""
        place = np.empty(d.num_rows, np.int64)
        place[pc.sort_indices(d.column("did"), null_placement="at_start").to_numpy()] = np.arange(d.num_rows)
        order = np.lexsort((place[j], dist, slot, i))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(i[order]) != 0) | (np.diff(slot[order]) != 0)
        start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        return order[np.arange(len(order)) - start < self.k]

    def slot_sets(self, ma, mb, d):
        everyone = np.arange(len(mb))
        if self.slots == "missing":
            for c in np.flatnonzero(~ma.all(axis=0)):
                yield int(c), np.flatnonzero(~ma[:, c]), np.flatnonzero(mb[:, c])
        elif self.slots is not None:
            group = d.column("slot").to_numpy()
            for g in np.unique(group):
                yield int(g), np.arange(len(ma)), np.flatnonzero(group == g)
        else:
            yield 0, np.arange(len(ma)), everyone


def nearest(queries: DataFrame, donors: DataFrame, coords: list[str], k: int, qid: str, did: str,
            q_extra: list[str] = (), d_extra: list[str] = (), exclude_self: bool = False, apart: str | None = None,
            slots: str | None = None, eps0: float | None = None, growth: float = 4.0) -> DataFrame:
    """(qid, q_extra..., did, d_extra..., dist, rank) for the k nearest donors of every query row.

    ``queries`` and ``donors`` carry the coordinate columns (NULL = missing); ``q_extra`` /
    ``d_extra`` are carried through. Ties are broken by donor id. Queries with no defined distance
    to any donor return no row; an empty side gives an empty result. Keys must be unique.

    ``exclude_self``: a donor with the query's key does not count. ``apart``: a column of both
    sides; donors with the query's value do not count. ``slots``: search k donors for several slots
    of a query in one go, and return ``slot`` too:

    * ``"missing"``: a slot per coordinate the query lacks, with donors that have it; ``slot`` is
      its position in ``coords`` and ``value`` the donor's value;
    * an integer column of the donors: a slot per value. Enough are searched to find the k nearest
      donors with any one value left out (``leaving_out``), and k of each value within that radius.
    """
    n = len(coords)
    vector = F.array(*[col(c).cast("double") for c in coords]).alias("v")
    own_slot = slots if slots not in (None, "missing") else None
    q = queries.select(col(qid).alias("qid"), F.struct(F.lit(0).alias("_"), *[col(e) for e in q_extra]).alias("qx"), vector,
                       *([col(apart).alias("qpart")] if apart else []))
    d = donors.select(col(did).alias("did"), F.struct(F.lit(0).alias("_"), *[col(e) for e in d_extra]).alias("dx"), vector,
                      *([col(apart).alias("dpart")] if apart else []),
                      *([col(own_slot).cast("long").alias("slot")] if own_slot else []))
    # every widening round reads both sides: materialise the projected inputs once
    q, d = cut_lineage(q), cut_lineage(d)
    schema = StructType([q.schema["qid"], q.schema["qx"], d.schema["did"], d.schema["dx"]]) \
        .add("slot", LongType()).add("value", DoubleType()).add("dist", DoubleType())
    ranged = StructType(list(schema.fields)).add("radius", DoubleType()).add("asked", LongType())
    dp, qp = profile(d, n), profile(q, n)
    results = []
    if dp and qp:
        plan = KeyPlan(dp, qp)
        n_donors = d.count()
        plan.cut(d, n_donors)
        d = cut_lineage(with_keys(d, plan))
        pending = cut_lineage(searchable(q, plan, slots).withColumn("reach", F.lit(None).cast("double")))
        search = BlockSearch(plan, k, slots, exclude_self, apart is not None)
        pivot_kappa = len(plan.coordinates) if plan.pivots is not None else -1
        eps, span = eps0 or min(first_width(d, pivot_kappa), plan.range * 2), 1

        def block(left: pa.Table, right: pa.Table) -> pa.Table:
            if len(left) and len(right):
                i, slot, j, dist = search(left, right)
            else:                                        # a block that only one side has
                i = slot = j = np.zeros(0, np.int64)
                dist = np.zeros(0)
            value = matrix(right.column("v"), n)[j, slot] if slots == "missing" else np.zeros(len(j))
            asked = np.isnan(matrix(left.column("v"), n)[:, plan.given]).sum(axis=1)[i] if len(i) else i
            i, j = pa.array(i), pa.array(j)
            return pa.table([left.column("qid").take(i), left.column("qx").take(i), right.column("did").take(j),
                             right.column("dx").take(j), pa.array(slot), pa.array(value), pa.array(dist),
                             left.column("radius").take(i), pa.array(asked)], names=ranged.names)

        while True:
            last = span >= plan.cells - 1 and (pivot_kappa < 0 or eps >= plan.range * 2)
            look = pending.withColumn("reach", F.lit(None).cast("double")) if last else pending
            merge = plan.cells.bit_length() if last else merged(look, plan, span) if results else 0
            left, right = dealt(placed(look, plan, eps, span, merge), d, eps, pivot_kappa, merge)
            found = left.groupBy(*BLOCK).cogroup(right.groupBy(*BLOCK)).applyInArrow(block, ranged)
            w = Window.partitionBy("qid", "slot").orderBy("dist", "did")
            ranked = cut_lineage(found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
            if last:
                results.append(ranked)
                break
            state = reached(ranked, k, slots)
            results.append(ranked.join(state.filter("settled"), "qid", "left_semi"))
            pending = cut_lineage(pending.drop("reach").join(state, "qid", "left").filter(~F.coalesce("settled", F.lit(False)))
                                  .drop("settled"))
            rest, need = pending.agg(F.count(F.lit(1)), F.percentile_approx("reach", 0.9)).first()
            if not rest:
                break
            if rest * n_donors <= REST_PAIRS:
                # few are left: comparing them with all donors costs less than further rounds
                eps, span = plan.range * 2, plan.cells
            else:
                eps, span = min(eps * growth, max(need or math.inf, eps * 1.5)), span * 4
    out = reduce(lambda x, y: x.unionByName(y), results) if results else \
        queries.sparkSession.createDataFrame([], StructType(list(schema.fields)).add("rank", IntegerType()))
    extra = ["slot"] + (["value"] if slots == "missing" else []) if slots else []
    return out.select(F.col("qid").alias(qid), *[F.col("qx")[e].alias(e) for e in q_extra],
                      F.col("did").alias(did if did != qid else f"{did}_donor"), *[F.col("dx")[e].alias(e) for e in d_extra],
                      *extra, "dist", "rank")


def first_width(keyed: DataFrame, pivot_kappa: int) -> float:
    """A width of pivot cells at which about ``CELL_ROWS`` donors share one, from the keys' deviations;
    if all donors do, one cell is wide enough for all."""
    if pivot_kappa < 0:
        return math.inf
    r = keyed.filter(F.col("kappa") == pivot_kappa).agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("x1").alias("s1"),
                                                        F.stddev_pop("x2").alias("s2")).first()
    cells = r["n"] / CELL_ROWS
    return (4 * max(r["s1"], r["s2"]) / math.sqrt(cells) if cells > 1 else 0.0) or math.inf


def reached(ranked: DataFrame, k: int, slots: str | None) -> DataFrame:
    """(qid, settled, reach) of the queries that found a donor: whether no donor left out can change the
    answer, and a distance that no donor of the answer is beyond, NULL if fewer than k were found."""
    inside = F.col("dist") < F.col("radius")
    per = ranked.groupBy("qid", "slot").agg(F.count_if(inside).alias("c"), F.max(F.when(F.col("rank") == k, F.col("dist"))).alias("kth"),
                                            F.max("asked").alias("asked"))
    all_of = F.when(F.count("kth") == F.count(F.lit(1)), F.max("kth"))
    if slots is None:
        return per.groupBy("qid").agg((F.min("c") >= k).alias("settled"), all_of.alias("reach"))
    if slots == "missing":
        return per.groupBy("qid").agg((F.count_if(F.col("c") >= k) == F.max("asked")).alias("settled"),
                                      F.when(F.count("kth") == F.max("asked"), F.max("kth")).alias("reach"))
    # with the fullest value left out, k must remain: so they do at the second of the k-th distances
    return per.groupBy("qid").agg((F.sum("c") - F.max("c") >= k).alias("settled"),
                                  F.get(F.sort_array(F.collect_list("kth")), F.lit(1)).alias("reach"))


def leaving_out(found: DataFrame, runs: DataFrame, k: int, qid: str, did: str) -> DataFrame:
    """The k nearest donors per (query, run), donors of the slot ``run`` left out.

    ``found``: a ``nearest`` with a slot column of the donors; ``runs`` (qid, run): the runs each
    query takes part in. Adds ``run`` and ranks anew."""
    j = found.drop("rank").join(runs, qid).filter(F.col("slot") != F.col("run"))
    w = Window.partitionBy(qid, "run").orderBy("dist", did)
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
