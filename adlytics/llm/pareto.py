"""Mixing sources to target weights by Pareto order sampling (operator 3), in DataFrame operations.

Every source has a target in words. Targets start as shares of a total by source weight; a target
stops at ``max_copies`` times its source's size and the excess goes to the other sources by
weight, until none is above (water filling). The whole part of target over size is that many
certain copies of every document of the source. The words left over are sampled, once more per
document at most, with inclusions in proportion to the document's size,

    L = min(1, lambda * size),      sum of L * size over the source = the words left,

so long documents are likelier than short ones. Documents with L = 1 are certain copies too. The
others are ranked by the Pareto order variable

    q = (u / (1 - u)) / (L / (1 - L)),      u uniform in (0, 1) from a hash of the doc_id

and taken in ascending order while at least half of a document still fits the words that are left
(the sample's size is fixed in words, so each source ends within half a document of its target).
``lambda`` follows in closed form from a source's distinct sizes: with the larger ones certain, the
first size s, from the largest down, with lambda * s <= 1.

The running sum of words in that order is exact and never gathers a source into one task: q is cut
into slices (about one for ``SLICE_ROWS`` documents), slices are summed per source, and only the
one slice per source that the target falls into is ordered row by row. What remains is one cut per
source, against which every row is judged where it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlytics.llm.common import WORD, saved, sized_broadcast

# Fixed values of the mix: weights by source in code point order, repeating; total as a share of
# all words; most copies of a document.
WEIGHTS = [5, 2, 1]
SHARE = 1.5
MAX_COPIES = 2
SLICE_ROWS, LEAST_SLICES = 1024, 1024
MAX_BROADCAST_SOURCES = 50_000     # beyond, sources are joined by shuffle


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_copies=MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Water filling in closed form: with sources in the order of cap / weight, the ones that stop
    at their cap come first; the level of the rest is what is left of the total over their weight.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_copies)) \
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    s = s.withColumn("total", F.sum("source_size").over(everything) * share) \
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / F.sum("weight").over(rest))
    first_open = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)
    level = first_open["level"]
    return s.select("source", "source_size",
                    F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight"))).alias("target"))


def uniform(doc_id: str = "doc_id") -> Column:
    """Uniform in (0, 1) from the md5 of the id as text (a null id counts as the text 'null')."""
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")), 1, 12), 16, 10)
    return (h.cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def inclusion_rates(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with whole (certain copies of every document), lam and left (words to sample
    beyond all certain copies). A source with nothing to sample has no lam."""
    hist = sized.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    base = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("words", F.col("target") - F.col("whole") * F.col("source_size"))
    # distinct sizes of a source: few, whatever its number of documents
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    larger = F.coalesce(F.sum(F.col("n") * F.col("size")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    square = F.sum(F.col("n") * F.col("size") * F.col("size")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    h = hist.withColumn("larger", larger).withColumn("square", square)
    rated = with_source(h, base.select("source", "words")).filter("words > 0") \
        .withColumn("lam", (F.col("words") - F.col("larger")) / F.col("square").cast("double"))
    lam = rated.filter(F.col("lam") * F.col("size") <= 1).groupBy("source").agg(F.max_by("lam", "size").alias("lam"))
    sure = with_source(hist, lam).filter(F.col("lam") * F.col("size") >= 1).groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("sure"))
    lam, sure = lam.withColumnRenamed("source", "_ls"), sure.withColumnRenamed("source", "_ss")
    return base.join(lam, F.col("source").eqNullSafe(F.col("_ls")), "left").join(sure, F.col("source").eqNullSafe(F.col("_ss")), "left") \
        .withColumn("left", F.col("words") - F.coalesce("sure", F.lit(0))).drop("_ls", "_ss", "sure", "words")


def order_columns(d: DataFrame) -> DataFrame:
    """Adds whole copies, the sampled inclusion (0 for none and for certain copies) and the Pareto
    variable q to rows that carry doc_id, size, whole and lam."""
    rate = F.coalesce(F.col("lam") * F.col("size"), F.lit(0.0))
    return d.withColumn("_whole", F.col("whole") + F.when(rate >= 1, 1).otherwise(0)) \
        .withColumn("_part", F.when(rate >= 1, 0.0).otherwise(rate)) \
        .withColumn("_u", uniform()) \
        .withColumn("_q", F.when(F.col("_part") > 0, (F.col("_u") / (1 - F.col("_u")))
                                 / (F.col("_part") / (1 - F.col("_part")))))


def source_cuts(sized: DataFrame, targets: DataFrame, slices: int) -> DataFrame:
    """(source, source_size, target, whole, lam, _cut, last): per source, the slice the words left
    fall into and the last place (q, doc_id, size) taken in it; nulls where nothing of the order is.
    ``targets``: of ``inclusion_rates``."""
    d = order_columns(with_source(sized, targets)).filter("_part > 0") \
        .withColumn("_slice", F.floor(F.col("_q") / (1 + F.col("_q")) * slices))
    sums = d.groupBy("source", "_slice").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    order = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # the slice in which the target is reached
    cut = sums.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0))) \
        .filter("before + words >= left").groupBy("source").agg(F.min(F.struct("_slice", "before")).alias("c")) \
        .select(F.col("source").alias("_cs"), F.col("c._slice").alias("_cut"), F.col("c.before").alias("_before"))
    inner = d.join(cut, F.col("source").eqNullSafe(F.col("_cs"))).filter("_slice = _cut")
    rows = Window.partitionBy("source").orderBy("_q", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    taken = inner.withColumn("_sum", F.col("_before") + F.coalesce(F.sum("size").over(rows), F.lit(0))) \
        .filter(F.col("_sum") + F.col("size") / 2 <= F.col("left")) \
        .groupBy("source").agg(F.max(F.struct(F.col("_q").alias("q"), F.col("doc_id").alias("doc"), F.col("size").alias("words"))).alias("last")) \
        .select(F.col("source").alias("_ts"), "last")
    return targets.join(cut, F.col("source").eqNullSafe(F.col("_cs")), "left") \
        .join(taken, F.col("source").eqNullSafe(F.col("_ts")), "left") \
        .select("source", "source_size", "target", "whole", "lam", "_cut", "last")


def with_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source (one row per source, null is a source)."""
    t = sized_broadcast(table.withColumnRenamed("source", "_of"), MAX_BROADCAST_SOURCES)
    return rows.join(t, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def copies(rows: DataFrame, cuts: DataFrame, slices: int) -> DataFrame:
    """``rows`` (doc_id, source, size, ...) with source_size, target and the number of copies.

    A row is taken if its slice is before its source's cut slice, or in it and not after the last
    taken place; rows of equal doc_id and size are taken or left together.
    """
    d = order_columns(with_source(rows, cuts)) \
        .withColumn("_slice", F.floor(F.col("_q") / (1 + F.col("_q")) * slices))
    place = F.struct(F.col("_q").alias("q"), F.col("doc_id").cast("long").alias("doc"), F.col("size").alias("words"))
    extra = F.when(F.coalesce(F.col("_part") <= 0, F.lit(True)), 0) \
        .when(F.col("_cut").isNull() | (F.col("_slice") < F.col("_cut")), 1) \
        .when((F.col("_slice") == F.col("_cut")) & (place <= F.col("last")), 1).otherwise(0)
    return d.withColumn("copies", (F.col("_whole") + extra).cast("long")) \
        .drop("_whole", "_part", "_u", "_q", "_slice", "_cut", "last", "whole", "lam")


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(sized rows, cuts, slices): sizes are counted once and saved, as narrow rows."""
    sized = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                              n_words().alias("size")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    slices = max(LEAST_SLICES, sized.count() // SLICE_ROWS)
    targets = saved(inclusion_rates(sized, saved(source_targets(sizes))))
    return sized, saved(source_cuts(sized, targets, slices)), slices


def mix_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken), one row per row of ``docs``.

    ``size`` is the number of words of the text (null: 0), ``taken`` is copies * size. A null
    source is a source of its own, last in order. Empty documents take nothing whatever their
    copies; a source of empty documents has the target 0; an empty table gives no rows.
    """
    sized, cuts, slices = plan(docs)
    return copies(sized, cuts, slices).withColumn("taken", F.col("copies") * F.col("size")) \
        .select("doc_id", "size", "source", "source_size", "target", "copies", "taken")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, each as often as the mix takes it (0 to
    ``MAX_COPIES`` times). Texts stay where they are: only the cuts of the sources move."""
    _, cuts, slices = plan(docs)
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id"),
                         F.col("source").cast("string").alias("source"), n_words().alias("size"))
    return copies(packed, cuts, slices).filter("copies > 0") \
        .select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")


# The same rules in DuckDB SQL.
MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM {{docs}}),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight
      FROM src),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
          / sum(weight) OVER (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM c),
lv AS (SELECT arg_min(level, ratio) FILTER (WHERE level <= ratio) AS level FROM l),
t AS (SELECT source, source_size, CASE WHEN lv.level IS NULL THEN cap ELSE least(cap, lv.level * weight) END AS target
      FROM l, lv),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
w2 AS (SELECT *, target - whole * source_size AS words FROM b),
hist AS (SELECT source, size, count(*) AS n FROM sized WHERE size > 0 GROUP BY source, size),
rated AS (SELECT h.source, size, n, (words - coalesce(sum(n * size) OVER (PARTITION BY h.source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / CAST(sum(n * size * size) OVER (PARTITION BY h.source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lam
      FROM hist h JOIN w2 ON h.source IS NOT DISTINCT FROM w2.source WHERE words > 0),
lam AS (SELECT source, arg_max(lam, size) AS lam FROM rated WHERE lam * size <= 1 GROUP BY source),
sure AS (SELECT h.source, sum(n * size) AS sure FROM hist h JOIN lam ON h.source IS NOT DISTINCT FROM lam.source
      WHERE lam.lam * size >= 1 GROUP BY h.source),
rates AS (SELECT w2.*, lam.lam, words - coalesce(sure, 0) AS remain FROM w2
      LEFT JOIN lam ON w2.source IS NOT DISTINCT FROM lam.source LEFT JOIN sure ON w2.source IS NOT DISTINCT FROM sure.source),
d AS (SELECT sized.*, source_size, target, whole, remain, coalesce(lam * size, 0.0::DOUBLE) AS rate,
        (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / {float(1 << 48)}::DOUBLE AS u
      FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source),
q AS (SELECT *, CASE WHEN rate > 0 AND rate < 1 THEN (u / (1 - u)) / (rate / (1 - rate)) END AS q FROM d),
r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS running FROM q),
mixed AS (SELECT *, whole + CASE WHEN rate >= 1 THEN 1 WHEN q IS NOT NULL AND running + size / 2.0::DOUBLE <= remain THEN 1 ELSE 0 END AS copies FROM r)
"""
