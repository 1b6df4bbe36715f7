"""Silver kept up to date from the day's rows.

Stored are the winners of all keys, before the silver filter. A day is reduced to its best row per key and merged with
them by the same order that a run over all days has, so days may come in any order and may come twice. The filter sees
winners only: a masked newcomer that beats a row takes it out of silver. Raw rows of earlier days are never read again;
a day costs one pass over its rows and one over the winners, which are written aside and then put in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierloom.constants import ORG
from tierloom.operators.dedupe import dedupe_employments, dedupe_phones
from tierloom.plans import silver
from tierloom.sources.writers import publish, recover, write_aside

Step = Callable[[DataFrame], DataFrame]


def stored_winners(spark: SparkSession, path: str) -> DataFrame | None:
    """Winners of all days so far, if there are any."""
    recover(spark, path)
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def merge_day(
    spark: SparkSession, cleaned_day: DataFrame, path: str, dedupe: Step, view: Step = lambda rows: rows, keys: Sequence[str] = (), changes_to: str = ""
) -> DataFrame:
    """Merge a day's cleaned rows into the winners stored below a path; the view of the winners afterwards.

    The day is reduced before it meets the winners, so a key with very many rows is one row per task by then. With
    ``changes_to`` a table of what the day did to the view is written there before the winners take their place.
    """
    best, held = dedupe(cleaned_day), stored_winners(spark, path)
    merged = best if held is None else dedupe(held.unionByName(best))
    aside = write_aside(merged, path, "parquet")
    if changes_to:
        changes(None if held is None else view(held), view(spark.read.schema(merged.schema).parquet(aside)), keys).write.mode("overwrite").parquet(changes_to)
    publish(spark, aside, path)
    return view(spark.read.schema(merged.schema).parquet(path))


def changes(before: DataFrame | None, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of silver that a day ``added``, ``changed`` or ``removed``; null parts of a key count as equal."""
    old = after.where("false") if before is None else before
    row = F.struct(*[F.col(f"`{c}`") for c in after.columns])
    sides = [df.select(*keys, F.when(F.lit(is_new), row).alias("_new"), F.when(F.lit(not is_new), row).alias("_old")) for df, is_new in ((after, True), (old, False))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.any_value("_new", True).alias("_new"), F.any_value("_old", True).alias("_old"))
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return both.withColumn("change", kind).where("change is not null").select(*keys, "change")


def update_employments(spark: SparkSession, day: DataFrame, path: str, org: str = ORG, tie_break: Sequence[str] = (), changes_to: str = "") -> DataFrame:
    """Silver employments after a day of raw rows; winners are stored below the path."""
    return merge_day(
        spark,
        silver.clean_employments(day, org),
        path,
        lambda rows: dedupe_employments(rows, None, tie_break),
        lambda winners: winners.where(silver.employment_filter(org)).select(*[org if c == ORG else c for c in silver.EMPLOYMENT_COLUMNS]),
        ("contact_id", "occupation", "start_date"),
        changes_to,
    )


def update_phones(
    spark: SparkSession, day: DataFrame, path: str, org: str = ORG, remove_masked: bool = False, tie_break: Sequence[str] = (), changes_to: str = ""
) -> DataFrame:
    """Silver phones after a day of raw rows; winners are stored below the path."""
    where = silver.phone_filter() & silver.not_masked(org) if remove_masked else silver.phone_filter()
    return merge_day(
        spark,
        silver.clean_phones(day, org),
        path,
        lambda rows: dedupe_phones(rows, None, tie_break),
        lambda winners: winners.where(where).select(*[org if c == ORG else c for c in silver.PHONE_COLUMNS]),
        ("contact_id", "number"),
        changes_to,
    )
