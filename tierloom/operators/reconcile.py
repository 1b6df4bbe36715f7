"""Comparing two layers of one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierloom.operators.joins import measured
from tierloom.sources.writers import stored


def _null_rates(df: DataFrame, layer: str, columns: Sequence[str]) -> DataFrame:
    rates = [F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in columns]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(f"{layer}_null_rate")) for c in columns])
    return df.agg(*rates).select(F.inline(rows))


def null_rate_by_layer(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """Share of nulls per column in both layers, for the columns both have."""
    shared = [c for c in raw.columns if c in silver.columns]
    return _null_rates(raw, "raw", shared).join(_null_rates(silver, "silver", shared), "column")


def _both(raw: DataFrame, silver: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of both layers that have a whole key: the key, and the columns once per layer."""
    sides = []
    for layer, df in (("raw", raw), ("silver", silver)):
        values = [F.col(f"`{c}`").alias(f"_{layer}_{c}") for c in columns]
        known = " and ".join(f"`{k}` is not null" for k in keys)
        sides.append(df.where(known).select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key"), F.lit(layer).alias("_layer"), *values))
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


def _bounds(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and largest value per key, layer and column; a key's rows are merged before they are shuffled."""
    names = [f"_{layer}_{c}" for layer in ("raw", "silver") for c in columns]
    return both.groupBy("_key").agg(*[f(F.col(f"`{n}`")).alias(f"{n}{end}") for n in names for f, end in ((F.min, "_low"), (F.max, "_high"))])


def _single(layer: str, column: str) -> Column:
    """Whether a key has one value of the column in a layer, in however many rows."""
    return F.col(f"`_{layer}_{column}_low`") == F.col(f"`_{layer}_{column}_high`")


def repeated_keys(raw: DataFrame, silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per layer: keys with more than one row, and the rows they have."""
    out = []
    for layer, df in (("raw", raw), ("silver", silver)):
        counts = df.groupBy(*keys).count().where("count > 1")
        out.append(counts.agg(F.count("*").alias("keys"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows")).select(F.lit(layer).alias("layer"), "keys", "rows"))
    return out[0].unionByName(out[1])


def undecided_keys(raw: DataFrame, silver: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per column: keys with several values in both layers, for which ``scale_drift`` compares means."""
    several = [F.count_if(~_single("raw", c) & ~_single("silver", c)).alias(c) for c in columns]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("keys")) for c in columns])
    return _bounds(_both(raw, silver, keys, columns), columns).agg(*several).select(F.inline(rows))


def nulls_became_default(
    raw: DataFrame, silver: DataFrame, keys: Sequence[str], columns: Sequence[str], default: object = 0
) -> DataFrame:
    """Rows that are null in raw and whose key holds the default in silver, per column.

    Every raw row counts once, however many rows its key has in either layer. One grouped pass over both layers: a key
    with a third of all rows is a few rows by the time it is shuffled.
    """
    nulls = [F.count_if((F.col("_layer") == "raw") & F.col(f"`_raw_{c}`").isNull()).alias(f"_raw_{c}") for c in columns]
    held = [F.max(F.col(f"`_silver_{c}`") == F.lit(default)).alias(f"_silver_{c}") for c in columns]
    by_key = _both(raw, silver, keys, columns).groupBy("_key").agg(*nulls, *held)
    counts = [F.coalesce(F.sum(F.when(F.col(f"`_silver_{c}`"), F.col(f"`_raw_{c}`"))), F.lit(0)).alias(c) for c in columns]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("defaulted")) for c in columns])
    return by_key.agg(*counts).select(F.inline(rows))


def _layer_bounds(df: DataFrame, layer: str, columns: Sequence[str]) -> DataFrame:
    bounds = [
        F.struct(F.lit(c).alias("column"), F.min(c).cast("double").alias(f"{layer}_min"), F.max(c).cast("double").alias(f"{layer}_max")).alias(c)
        for c in columns
    ]
    return df.agg(*bounds).select(F.inline(F.array(*columns)))


LAYERS = ("raw", "silver")


def _numbers(raw: DataFrame, silver: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of both layers: key, layer and the columns as ``n0``, ``n1`` and so on; rows without a whole key have none."""
    whole = " and ".join(f"`{k}` is not null" for k in keys)
    sides = []
    for layer, df in zip(LAYERS, (raw, silver), strict=True):
        key = [F.when(F.expr(whole), F.col(f"`{k}`")).alias(f"k{i}") for i, k in enumerate(keys)]
        sides.append(df.select(*key, F.lit(layer).alias("layer"), *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"n{i}") for i, c in enumerate(columns)]))
    return sides[0].unionByName(sides[1])


def scale_drift(raw: DataFrame, silver: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Ranges in both layers and, with keys, the middle ratio silver to raw.

    Every raw row, copies included, has a ratio to the silver value of its key. If silver has several, every silver row
    has a ratio to the one raw value. If both layers have several values of a key, which goes with which is not known:
    each raw row then has the ratio of the means of the key; ``undecided_keys`` counts these keys.

    Each layer is read once, and a key is one row by task when it is shuffled, however many rows it has. What is known
    of the keys is written; only if one layer has several values where the other has one, the rows of these keys are read
    again. The middle is exact if the ratios that agree with it in ``digits`` digits are equal, and else right in that
    many digits.
    """
    if not keys:
        return _layer_bounds(raw, "raw", columns).join(_layer_bounds(silver, "silver", columns), "column")
    key = [f"k{i}" for i in range(len(keys))]
    numbers = _numbers(raw, silver, keys, columns)
    stats = []
    for i in range(len(columns)):
        for layer in LAYERS:
            value = F.when(F.col("layer") == layer, F.col(f"n{i}"))
            stats += [f(value).alias(f"{layer}_{name}{i}") for name, f in (("low", F.min), ("high", F.max), ("sum", F.sum), ("rows", F.count))]
    # One row per key and column; the key null holds rows without a key, which count for the ranges only.
    by_key = stored(numbers.groupBy(*key).agg(*stats))
    names = [f"{layer}_{name}" for layer in LAYERS for name in ("low", "high", "sum", "rows")]
    each = F.array(*[F.struct(F.lit(i).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i in range(len(columns))])
    facts = by_key.select(*key, F.explode(each).alias("f")).select(*key, "f.*")
    ends = facts.groupBy("column").agg(*[f(f"{layer}_{end}").alias(f"{layer}_{f.__name__}") for layer in LAYERS for f, end in ((F.min, "low"), (F.max, "high"))])

    one = {layer: F.col(f"{layer}_low") == F.col(f"{layer}_high") for layer in LAYERS}
    mean = {layer: F.col(f"{layer}_sum") / F.nullif(F.col(f"{layer}_rows"), F.lit(0)) for layer in LAYERS}
    keyed = facts.where(F.col(key[0]).isNotNull() & (F.col("raw_rows") > 0) & (F.col("silver_rows") > 0))
    plain = keyed.where(one["raw"] == one["silver"])
    of_keys = F.when(one["raw"], F.try_divide("silver_low", "raw_low")).otherwise(F.try_divide(mean["silver"], mean["raw"]))
    ratios = plain.select("column", of_keys.alias("ratio"), F.col("raw_rows").alias("rows"))
    uneven = keyed.where(one["raw"] != one["silver"]).select(*key, "column", F.when(one["raw"], "silver").otherwise("raw").alias("layer"), F.when(one["raw"], F.col("raw_low")).otherwise(F.col("silver_low")).alias("base"))
    counts, small = measured({"uneven": uneven.limit(1)}, {"uneven keys": uneven})
    if counts["uneven"]:
        few = small["uneven keys"]
        values = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"n{i}").alias("value")) for i in range(len(columns))]))
        rows = numbers.select(*key, "layer", values.alias("v")).select(*key, "layer", "v.*").where("value is not null")
        # Copies become counts before they meet a key that had to be shuffled.
        counted = rows.withColumn("rows", F.lit(1).cast("long")) if few else rows.groupBy(*key, "layer", "column", "value").agg(F.count("*").alias("rows"))
        met = counted.join(F.broadcast(uneven) if few else uneven, [*key, "layer", "column"])
        ratio = F.when(F.col("layer") == "raw", F.try_divide("base", "value")).otherwise(F.try_divide("value", "base"))
        ratios = ratios.unionByName(met.select("column", ratio.alias("ratio"), "rows"))
    return ends.join(_middle(ratios, digits), "column", "left").withColumn("column", F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column") + 1))


def _middle(ratios: DataFrame, digits: int) -> DataFrame:
    """Median of counted ratios per column. Those that agree in their leading digits are counted together, so however many
    there are, a bounded number of them meets in one task."""
    size = F.coalesce(F.floor(F.log10(F.abs(F.nullif(F.col("ratio"), F.lit(0.0))))), F.lit(0)) - (digits - 1)
    place = F.round(F.col("ratio") / F.pow(F.lit(10.0), size)).cast("long")
    near = ratios.where("ratio is not null").groupBy("column", size.alias("size"), place.alias("place")).agg(F.sum("rows").alias("rows"), F.min("ratio").alias("ratio"))
    upto = Window.partitionBy("column").orderBy("ratio").rowsBetween(Window.unboundedPreceding, 0)
    placed = near.select("column", "ratio", F.sum("rows").over(upto).alias("upto"), F.sum("rows").over(Window.partitionBy("column")).alias("all"))
    return placed.where("upto * 2 >= all").groupBy("column").agg(F.min("ratio").alias("median_ratio"))


def key_traceability(raw: DataFrame, silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys in raw only, in silver only, in both, and the share of raw keys found in silver.

    One grouped pass over both layers; a key's rows are merged before they are shuffled.
    """
    sides = [
        df.select(*keys, F.lit(is_raw).alias("_raw"), F.lit(not is_raw).alias("_silver"))
        for df, is_raw in ((raw, True), (silver, False))
    ]
    found = sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.max("_raw").alias("_raw"), F.max("_silver").alias("_silver"))
    both = F.col("_raw") & F.col("_silver")
    counted = found.agg(
        F.count_if(F.col("_raw") & ~F.col("_silver")).alias("raw_only"),
        F.count_if(F.col("_silver") & ~F.col("_raw")).alias("silver_only"),
        F.count_if(both).alias("matched"),
    )
    return counted.withColumn("matched_share", F.try_divide(F.col("matched"), F.col("matched") + F.col("raw_only")))


def boolean_domain(df: DataFrame, columns: Sequence[str], expected: Sequence[str] = ("true", "false")) -> DataFrame:
    """Values of flag columns with their counts, and whether each is expected."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.lower(F.col(c).cast("string")).alias("value")) for c in columns])
    )
    counts = df.select(pairs.alias("p")).select("p.column", "p.value").groupBy("column", "value")
    return counts.agg(F.count("*").alias("row_count")).withColumn(
        "expected", F.coalesce(F.col("value").isin(*expected), F.lit(False))
    )


def schema_diff(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """Columns that were added, dropped, moved or changed type: ``column``, ``change``, ``raw``, ``silver``."""
    before = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(raw.schema.fields)}
    after = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(silver.schema.fields)}
    rows = [(c, "dropped", before[c][1], None) for c in before if c not in after]
    rows += [(c, "added", None, after[c][1]) for c in after if c not in before]
    for c in before:
        if c in after and before[c][1] != after[c][1]:
            rows.append((c, "type", before[c][1], after[c][1]))
        if c in after and before[c][0] != after[c][0]:
            rows.append((c, "moved", str(before[c][0]), str(after[c][0])))
    return raw.sparkSession.createDataFrame(rows, "column string, change string, raw string, silver string")


def add_lineage_columns(
    df: DataFrame, source_table: str, source_timestamp: str | Column, loaded_at: Column, first: Sequence[str] = ()
) -> DataFrame:
    """Adds when a row was loaded, from which table, and its time there; ``first`` columns lead."""
    stamped = df.withColumns(
        {
            "_loaded_at": loaded_at,
            "_source_table": F.lit(source_table),
            "_source_timestamp": F.col(source_timestamp) if isinstance(source_timestamp, str) else source_timestamp,
        }
    )
    return stamped.select(*first, *[c for c in stamped.columns if c not in first])


def layer_row_counts(layers: Mapping[str, DataFrame], metrics: Mapping[str, Column] | None = None) -> DataFrame:
    """Row count and further metrics per layer."""
    extra = [m.alias(name) for name, m in (metrics or {}).items()]
    counts = [
        df.agg(F.count("*").alias("row_count"), *extra).select(F.lit(name).alias("layer"), "*")
        for name, df in layers.items()
    ]
    out = counts[0]
    for count in counts[1:]:
        out = out.unionByName(count)
    return out

