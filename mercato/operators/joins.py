"""Join helpers: lookups, null-safe group counts, substring semi join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.materialize import materialize


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The rows of ``df``; the job fails when a key stands on two of them.

    The rows of a key are counted over its window and the filter stops the job
    where there is more than one, so the test rides on the plan that uses the
    rows.  After a grouping by the same keys, or before a sort-merge join on
    them, the window needs no shuffle of its own.
    """
    counted = df.withColumn("_rows_of_key", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"{name}: repeated key ("), shown, F.lit(")"))
    return counted.where(F.assert_true(F.col("_rows_of_key") == 1, message).isNull()).drop("_rows_of_key")


def declared_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], name: str, how: str = "left") -> DataFrame:
    """A many-to-one join that can't multiply rows: a repeated key on the
    right fails the job.  Rows without a key match nothing and are left out first."""
    keys = [on] if isinstance(on, str) else list(on)
    keyed = right.dropna(subset=keys)
    return left.join(require_unique(keyed, keys, name), on=keys, how=how)


def by_shuffle(df: DataFrame) -> DataFrame:
    """A side that grows with the data (a row a customer, a product, an order), to be joined by sorting both sides.

    Without the hint Spark broadcasts a scan whose files are under the threshold,
    but files are compressed: 8 MB of products were tables of up to 258 MB in the
    driver, several of them at once in a publish.  Skewed partitions are still split.
    """
    return df.hint("merge")


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join to a lookup table of bounded size.  No hint: Spark broadcasts the lookup when
    its size in bytes is under ``spark.sql.autoBroadcastJoinThreshold``, and
    shuffles both sides otherwise."""
    return df.join(lookup, on=on, how=how)


def group_count_over(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """W3 without a window: ``COUNT(*) OVER (PARTITION BY keys)`` per row.

    A window would send a hot key's rows to one task; a partially aggregated
    ``groupBy`` count joined back on a null-safe key spreads the work.  The
    counts are written first: AQE splits a skewed partition only if nothing
    but the shuffle stands between it and the join.
    """
    counts = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), "group-counts")
    cond = [df[k].eqNullSafe(counts[k]) for k in keys]
    return df.join(counts, on=cond, how="inner").select(df["*"], counts[name])


#: Characters of the pieces that texts and values are met by.
GRAM = 3


def _grams(text, size: int):
    """Distinct pieces of ``size`` characters; of size 0 the empty one; none of a NULL or shorter text."""
    if size == 0:
        return F.when(text.isNotNull(), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    last = F.length(text) - size + 1
    pieces = F.transform(F.sequence(F.lit(1), last), lambda start: F.substring(text, start, size))
    return F.when(last >= 1, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def contains_other_value(left: DataFrame, key: Sequence[str], text_col: str, own_col: str,
                         values: DataFrame, value_col: str) -> DataFrame:
    """Rows of ``left`` whose lower(text) contains lower(v) for some value
    v of ``values`` with v <> the row's own value (literal substring match).

    The correlated EXISTS with a theta condition as an equi-join: a text that
    contains a value contains each of its q-grams, so the value is looked for
    by one of them, the one that the fewest texts hold, and what meets there is
    verified by ``contains``.  Rows grow with the texts' length, whatever the
    values' lengths; a value with a q-gram that no text holds meets nothing.
    Values shorter than a q-gram are their own piece.  No nested-loop join is
    planned.  ``key`` must identify rows of ``left``.  Returns the matching
    rows of ``left`` (left semi join).
    """
    key = list(key)
    cand = (values.select(F.col(value_col).alias("_v")).where(F.col("_v").isNotNull())
            .distinct().select("_v", F.lower("_v").alias("_lv")).withColumn("_size", F.least(F.length("_lv"), F.lit(GRAM))))
    # one small job: which of the sizes 0 .. GRAM there are
    sizes = sorted(r["_size"] for r in cand.select("_size").distinct().collect())
    if not sizes:
        return left.where(F.lit(False))
    text = F.lower(F.col(text_col))
    pieces = F.flatten(F.array(*[_grams(text, n) for n in sizes]))
    exploded = left.select(*key, F.col(own_col).alias("_own"), text.alias("_text"), F.explode(pieces).alias("_gram"))
    value_pieces = reduce(lambda rest, n: F.when(F.col("_size") == n, _grams(F.col("_lv"), n)).otherwise(rest), sizes, F.array().cast("array<string>"))
    of_values = materialize(cand.select("_v", "_lv", F.explode(value_pieces).alias("_gram")), "value-grams")
    held = exploded.select("_gram").join(of_values.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (of_values.join(held, "_gram", "left").groupBy("_v", "_lv")
              .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_r"))
              .where("_r.n > 0").select("_v", "_lv", F.col("_r.gram").alias("_gram")))
    # the pieces of all texts look as small as their files, and would be broadcast
    hits = (by_shuffle(exploded).join(rarest, "_gram").where((F.col("_v") != F.col("_own")) & F.contains("_text", "_lv"))
            .select(*key).distinct())
    # what is hit grows with the texts, and is small enough for a broadcast only once it has been shuffled
    return left.join(by_shuffle(hits), on=key, how="left_semi")
