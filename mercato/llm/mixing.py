"""Mix sources to target weights with hash-threshold histograms.

Every row gets a 60-bit hash of its id.  A source's budget is a number of
words; the rows it takes are those whose hash lies below a threshold.  The
threshold is found without sorting: words are summed by (source, leading hash
bits), the bucket in which the running sum crosses the budget is found, and
only the rows of that bucket are summed again by the next bits, until the
crossing bucket holds a single row.  If it holds several rows with one id, the
hash of a second key, such as their text, goes on.  A budget above the source's own size is
nested: every row is taken once for each whole multiple, and the rest of the
budget picks the rows that are taken once more.

Histograms have at most ``2**BITS`` rows a source and are made by partial
aggregation, so a hot source costs no more than another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import materialize

HASH_BITS = 60
BITS = 12


def row_hash(key: Column) -> Column:
    """The first 60 bits of the md5 of the key's text, as a long."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, source_size) -> + target: ``share`` of all words by weight, capped.

    Weights are dealt in turn to the sources in code point order, null last.
    A target stops at ``cap`` times its source's size and the excess is shared
    again by weight until no target is above: all targets below their cap are
    then one level times their weight.  Sources are met in the order in which
    they reach their cap, so one pass finds the level.  One row a source.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = (sizes.withColumn("nth", F.row_number().over(by_name)).withColumn("w", weight)
              .withColumn("cap", F.col("source_size") * float(cap))
              .withColumn("total", F.sum("source_size").over(everything) * share)
              .withColumn("all_w", F.sum("w").over(everything)))
    before = (everything.orderBy(F.col("cap") / F.col("w"), "nth").rowsBetween(Window.unboundedPreceding, -1))
    left = (ranked.withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("rest_w", F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
            .withColumn("full", F.col("cap") * F.col("rest_w") <= F.col("rest") * F.col("w")))
    first = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), "nth", (F.col("rest") / F.col("rest_w")).alias("level")))).over(everything)
    return (left.withColumn("level", first["level"])
            .select("source", "source_size",
                    F.when(F.col("level").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("level") * F.col("w"))).alias("target")))


def thresholds(rows: DataFrame, goal: DataFrame, bits: int = BITS) -> DataFrame:
    """Per source: whole copies of every row, and the crossing bucket of one more.

    ``rows`` has source, size, h, h2; ``goal`` has source, source_size, target.
    Returns source, source_size, target, copies, shift, bucket, shift2, bucket2,
    inclusive: rows with ``h >> shift`` below ``bucket`` are taken once more; of
    those equal to it the ones with ``h2 >> shift2`` below ``bucket2``, and those
    equal to that as well if ``inclusive``.  ``h2`` is only looked at (``shift2``
    under ``HASH_BITS``) if rows with one ``h`` cross the budget.  The crossing
    bucket holds one row, or rows alike in both; it goes in when at least half
    of it fits.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = materialize(goal.withColumn("copies", copies).select(
        "source", "source_size", "target", "copies",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
        *(x for k in ("", "2") for x in (F.lit(HASH_BITS).alias("shift" + k), F.lit(0).cast("long").alias("bucket" + k))),
        F.lit(False).alias("inclusive"), F.lit(2).cast("long").alias("held")), "mix-state")
    running = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    for key, shift in ((k, n) for k in ("", "2") for n in range(HASH_BITS - bits, -1, -bits)):
        h = "h" + key
        open_ = state.filter("held > 1 and budget > 0").select(
            F.col("source").alias("s"), F.col("bucket").alias("first"), F.col("bucket" + key).alias("within"), F.col("budget").alias("b0"))
        if not open_.take(1):
            break
        in_bucket = F.col("source").eqNullSafe(F.col("s"))
        if key:
            in_bucket &= F.col("h") == F.col("first")
        if shift + bits < HASH_BITS:
            in_bucket &= F.shiftright(h, shift + bits) == F.col("within")
        hist = (rows.join(open_, in_bucket).groupBy("source", F.shiftright(h, shift).alias("b"))
                .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.first("b0").alias("b0")))
        below = F.coalesce(F.sum("words").over(running), F.lit(0))
        crossing = (hist.withColumn("below", below)
                    .filter((F.col("below") <= F.col("b0")) & (F.col("below") + F.col("words") > F.col("b0")))
                    .select(F.col("source").alias("s"), F.col("b"), F.col("n"),
                            (F.col("b0") - F.col("below")).alias("rest"),
                            (2 * (F.col("b0") - F.col("below")) >= F.col("words")).alias("half")))
        hit = F.col("b").isNotNull()
        moved = {"shift" + key: F.lit(shift), "bucket" + key: F.col("b")}
        state = materialize(state.join(crossing, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "copies",
            F.when(hit, F.col("rest")).otherwise(F.col("budget")).alias("budget"),
            *(F.when(hit, moved.get(c, F.col(c))).otherwise(F.col(c)).alias(c) for c in ("shift", "bucket", "shift2", "bucket2")),
            F.when(hit, F.col("half")).otherwise(F.col("inclusive")).alias("inclusive"),
            F.when(hit, F.col("n")).otherwise(F.lit(0)).cast("long").alias("held")), "mix-state")
    return state.drop("budget", "held")


def mix(rows: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: int = 2, bits: int = BITS) -> DataFrame:
    """Rows (id, source, size, and columns key2 and doc if there are) -> + source_size, target, taken.

    ``taken`` is size times the number of times that the row is taken, 0 to
    ``cap``.  A source's sum of ``taken`` differs from its target by half of
    one row at most (rows with the same id and ``key2`` are taken together).
    Reruns agree: the decision depends only on id, key2, source and the sizes.
    Null sources form one source, a null id or key2 counts as an empty one, null
    sizes as 0; an empty table gives an empty result.  Other columns are left out.
    """
    key2 = F.col("key2") if "key2" in rows.columns else F.lit("")
    rows = (rows.select("id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"), *(c for c in ("doc",) if c in rows.columns),
                        row_hash(F.col("id")).alias("h"), row_hash(key2).alias("h2")))
    narrow = materialize(rows.select("source", "size", "h", "h2"), "mix-rows")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = thresholds(narrow, targets(sizes, weights, share, cap), bits).withColumnRenamed("source", "s")
    at, at2 = F.expr("shiftright(h, shift)"), F.expr("shiftright(h2, shift2)")
    of_bucket = F.when(F.col("shift2") < HASH_BITS, (at2 < F.col("bucket2")) | ((at2 == F.col("bucket2")) & F.col("inclusive"))).otherwise(F.col("inclusive"))
    extra = (F.col("shift") < HASH_BITS) & ((at < F.col("bucket")) | ((at == F.col("bucket")) & of_bucket))
    return (rows.join(state, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("taken", F.col("size") * (F.col("copies") + extra.cast("long")))
            .drop("s", "h", "h2", "copies", "shift", "bucket", "shift2", "bucket2", "inclusive"))
