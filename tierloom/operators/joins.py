"""Left joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A key with more rows than this is split; it is also the share of such a key one task receives.
ROWS_PER_TASK = 1_000_000
# Keys kept per column: a key below this part of the table is no burden to one task among many. It bounds
# what reaches the driver. The sketch has four counters for each, so no key above that part is missed.
KEPT = 2_500
TRACKED = 4 * KEPT
# Tasks that merge sketches before the last merge; a sketch has TRACKED counters, so each gets a few MB.
MERGERS = 512
# Largest dimension table that is broadcast: bytes of its rows as text, and rows read to find out.
BROADCAST_BYTES = 8_000_000
BROADCAST_ROWS = 100_000

HeavyKeys = Mapping[str | None, int]

_LEFT, _RIGHT, _COPIES = "_left_part", "_right_part", "_copies"


def heavy_keys(df: DataFrame, columns: Sequence[str], rows: int = ROWS_PER_TASK) -> dict[str, dict]:
    """Keys with more than ``rows`` rows in each column, with their estimated row counts.

    One job reads only the key columns and keeps a frequent-item sketch per task; sketches, not keys, are
    shuffled, and are merged in two steps. In a large table a key must also hold more than one row in
    ``KEPT``, so at most that many keys per column reach the driver. The answer only steers how rows are
    spread over tasks: join results are the same whichever keys it names.
    """
    return heavy_keys_of({"": df.select(*columns)}, rows)[""]


def heavy_keys_of(tables: Mapping[str, DataFrame], rows: int = ROWS_PER_TASK, counts: Mapping[str, int] | None = None) -> dict[str, dict[str, dict]]:
    """``heavy_keys`` of all columns of several tables, in one job.

    ``counts`` are the tables' row counts if they are known: a table with at most ``rows`` rows has no heavy key and
    is not read.
    """
    found: dict[str, dict[str, dict]] = {name: {c: {} for c in df.columns} for name, df in tables.items()}
    read = {name: df for name, df in tables.items() if counts is None or counts[name] > rows}
    listed = [_sketched(df, name) for name, df in read.items()]
    for row in reduce(DataFrame.unionByName, listed).collect() if listed else ():
        least = max(rows, row["rows"] // KEPT)
        for column, items in row["items"].items():
            found[row["table"]][column] = {i["item"]: i["count"] for i in items if i["count"] > least}
    return found


def _sketched(df: DataFrame, name: str) -> DataFrame:
    """One row: the table's name, its rows, and the most frequent items of every column."""
    sketches = [F.expr(f"approx_top_k_accumulate(cast(`{c}` as string), {TRACKED})").alias(c) for c in df.columns]
    merged = [F.expr(f"approx_top_k_estimate(approx_top_k_combine(`{c}`, {TRACKED}), {KEPT})").alias(c) for c in df.columns]
    merger = (F.spark_partition_id() % MERGERS).alias("_merger")
    parts = df.select(merger, *[F.col(f"`{c}`") for c in df.columns]).groupBy("_merger").agg(F.count("*").alias("_rows"), *sketches)
    one = parts.groupBy(F.lit("all").alias("_all")).agg(F.sum("_rows").alias("rows"), *merged)
    items = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`"))])
    return one.select(F.lit(name).alias("table"), "rows", items.alias("items"))


def measured(counted: Mapping[str, DataFrame], looked_up: Mapping[str, DataFrame] | None = None, size: int = BROADCAST_BYTES) -> tuple[dict[str, int], dict[str, bool]]:
    """Row counts of some tables, and whether others are small enough to be broadcast, in one job."""
    parts = [df.agg(F.count("*").alias("rows"), F.lit(0).cast("long").alias("bytes")).withColumn("table", F.lit(name)) for name, df in counted.items()]
    parts += [_size(df).withColumn("table", F.lit(name)) for name, df in (looked_up or {}).items()]
    rows = {r["table"]: r for r in reduce(DataFrame.unionByName, parts).collect()}
    small = {name: rows[name]["rows"] <= BROADCAST_ROWS and rows[name]["bytes"] <= size for name in looked_up or {}}
    return {name: rows[name]["rows"] for name in counted}, small


def _size(df: DataFrame) -> DataFrame:
    """One row: rows and bytes of their text, of no more rows than it takes to tell whether a table is small."""
    row = F.octet_length(F.to_json(F.struct(*df.columns))) + 8
    return df.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("long").alias("bytes"))


def _pieces(heavy: HeavyKeys, rows: int) -> dict:
    """Parts per heavy key: as many as the key has multiples of ``rows``."""
    return {key: max(2, -(-n // rows)) for key, n in heavy.items()}


def _parts_table(spark: SparkSession, left: dict, right: dict) -> DataFrame:
    """Heavy keys with their left and right parts; at most twice ``KEPT`` rows."""
    listed = [{"k": k, "l": left.get(k, 1), "r": right.get(k, 1)} for k in {**left, **right} if k is not None]
    rows = F.from_json(F.lit(json.dumps(listed)), "array<struct<k:string,l:int,r:int>>")
    return spark.range(1).select(F.inline(rows)).toDF("_heavy", "_left_parts", "_right_parts")


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    heavy: HeavyKeys | None = None,
    right_heavy: HeavyKeys | None = None,
    rows: int = ROWS_PER_TASK,
    repeated: bool = False,
    distinct_left: bool = False,
    distinct_right: bool = False,
) -> DataFrame:
    """Left equi join; rows of heavy keys on either side are spread over many tasks.

    Rows of a heavy key are dealt to its parts by a hash of the row, and the other side's rows of that
    key are copied to each part, so every pair of rows still meets exactly once. Left rows without a key
    match nothing and are dealt out with no copies. Equal rows hash alike: pass ``repeated`` if the left
    side may hold copies of a row, which are then counted, merged in the tasks that read them, and written
    out again behind the join. The right side should hold none.

    ``distinct_left`` and ``distinct_right`` join the distinct rows of a side: copies meet in the shuffle of the
    join and are removed there, which saves a shuffle by all columns. They are not merged before it, so use this
    where no row has more than ``rows`` copies, and not on floating point columns, whose two zeros hash apart.
    """
    if not heavy and not right_heavy:
        left = left.repartition(left_key).distinct() if distinct_left else left
        right = right.repartition(right_key).distinct() if distinct_right else right
        return left.join(right, left[left_key] == right[right_key], "left")
    if repeated:
        counted = left.groupBy(*left.columns).agg(F.count("*").alias(_COPIES))
        joined = left_join(counted, right, left_key, right_key, heavy, right_heavy, rows, distinct_right=distinct_right)
        return joined.withColumn(_COPIES, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_COPIES)))).drop(_COPIES)

    right_text = right[right_key].cast("string")
    right_heavy = {k: n for k, n in (right_heavy or {}).items() if k is not None}
    if right_heavy:
        # Only keys that are there: a left row copied to their parts is then known to match.
        held = right.where(right_text.isin(*right_heavy)).select(right_text.alias("k")).distinct().collect()
        right_heavy = {r["k"]: right_heavy[r["k"]] for r in held}
    left_parts, right_parts = _pieces(heavy or {}, rows), _pieces(right_heavy, rows)
    for key in left_parts.keys() & right_parts.keys():
        # Rows of a key that is heavy on both sides multiply; a task gets the rows of one part as pairs, too.
        left_parts[key] = max(left_parts[key], -(-heavy[key] * right_heavy[key] // (rows * right_parts[key])))
    if not left_parts and not right_parts:
        return left_join(left, right, left_key, right_key, distinct_left=distinct_left, distinct_right=distinct_right)
    parts = F.broadcast(_parts_table(left.sparkSession, left_parts, right_parts))
    in_left, in_right = F.coalesce("_left_parts", F.lit(1)), F.coalesce("_right_parts", F.lit(1))

    def dealt(df: DataFrame, count: Column) -> Column:
        # Most rows have a light key and need no hash of all their columns.
        return F.when(count > 1, F.pmod(F.xxhash64(*df.columns), count)).otherwise(F.lit(0)).cast("int")

    def copied(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    # A side without heavy keys has one part, so the other side needs no copies and the join no column for it.
    in_a = ([_LEFT] if left_parts else []) + ([_RIGHT] if right_parts else [])
    in_b = (["_l"] if left_parts else []) + (["_r"] if right_parts else [])

    keyless = F.lit(left_parts.get(None, 1))
    a = left.join(parts, left[left_key].cast("string") == parts["_heavy"], "left").select(
        *left.columns,
        *([dealt(left, F.when(left[left_key].isNull(), keyless).otherwise(in_left)).alias(_LEFT)] if left_parts else []),
        *([copied(in_right).alias(_RIGHT)] if right_parts else []),
    )
    b = right.join(parts, right_text == parts["_heavy"], "left").select(
        *right.columns,
        *([copied(in_left).alias("_l")] if left_parts else []),
        *([dealt(right, in_right).alias("_r"), (in_right > 1).alias("_split")] if right_parts else []),
    )
    a = a.repartition(left_key, *in_a).distinct() if distinct_left else a
    b = b.repartition(right_key, *in_b).distinct() if distinct_right else b
    same = reduce(Column.__and__, [a[x] == b[y] for x, y in zip([left_key, *in_a], [right_key, *in_b])])
    out = a.join(b, same, "left")
    if right_parts:
        # A copy of a left row that met no right row in its part; the key's matches are in other parts.
        stray = b["_split"].isNull() & a[left_key].cast("string").isin(*right_parts)
        out = out.where(~F.coalesce(stray, F.lit(False)))
    return out.drop(*[a[x] for x in in_a], *[b[y] for y in in_b], *([b["_split"]] if right_parts else []))


def is_small(df: DataFrame, size: int = BROADCAST_BYTES) -> bool:
    """True if the table's rows, as text, have at most this many bytes; reads no more rows than it must to tell."""
    found = _size(df).first()
    return found["rows"] <= BROADCAST_ROWS and found["bytes"] <= size


def dimension_join(
    left: DataFrame,
    dimension: DataFrame,
    left_key: str,
    right_key: str,
    keys_from: DataFrame | None = None,
    size: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    small: bool | None = None,
) -> DataFrame:
    """Left join to the distinct rows of a table that is usually tiny.

    Its size in bytes is checked first, unless ``small`` says what a check found. Within the limit it is broadcast, so the few and therefore heavy keys
    shuffle nothing; beyond it the balanced shuffle join is used, with heavy keys looked up in
    ``keys_from``, a narrow table that holds the left keys.
    """
    small = is_small(dimension, size) if small is None else small
    dimension = dimension.distinct()
    if small:
        return left.join(F.broadcast(dimension), left[left_key] == dimension[right_key], "left")
    heavy = heavy_keys(left if keys_from is None else keys_from, [left_key], rows_per_task)[left_key]
    right_heavy = heavy_keys(dimension, [right_key], rows_per_task)[right_key]
    return left_join(left, dimension, left_key, right_key, heavy, right_heavy, rows_per_task)


def with_suffix(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every column name gets the suffix, except those listed."""
    return df.select(*[F.col(c).alias(c if c in keep else c + suffix) for c in df.columns])


def anti_join_distinct(df: DataFrame, other: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """Distinct ``keep`` columns of the rows whose key the other table does not hold.

    Both sides are reduced to distinct values before the join, so no key has many rows in it.
    """
    return df.select(*keep).distinct().join(other.select(key).distinct(), key, "left_anti")


def join_cardinality(
    base: DataFrame, steps: Sequence[tuple[str, DataFrame, str, str]], heavy: Mapping[str, HeavyKeys] | None = None, small: Mapping[str, bool] | None = None
) -> DataFrame:
    """Row counts before and after each left join of a chain, without building the wide rows.

    A step is ``(name, right, left_key, right_key)``. Each base row gets the number of its matches per
    step, at least 1; the running products, summed, are the counts. Steps that ``small`` says are small enough are looked
    up where the rows are; the others are shuffled, and nothing is computed to find out.
    """
    keys = list(dict.fromkeys(left_key for _, _, left_key, _ in steps))
    rows = base.groupBy(*keys).agg(F.count("*").alias("_rows"))
    for i, (name, right, left_key, right_key) in enumerate(steps):
        fanout = right.groupBy(F.col(right_key).alias(f"_key{i}")).agg(F.count("*").alias(f"_n{i}"))
        if (small or {}).get(name):
            # Its few and therefore heavy keys shuffle nothing.
            rows = rows.join(F.broadcast(fanout), rows[left_key] == fanout[f"_key{i}"], "left").drop(f"_key{i}")
        else:
            rows = left_join(rows, fanout, left_key, f"_key{i}", (heavy or {}).get(left_key)).drop(f"_key{i}")
    running, sums = F.col("_rows"), [F.sum("_rows").alias("_after0")]
    for i in range(len(steps)):
        running = running * F.coalesce(F.col(f"_n{i}"), F.lit(1))
        sums.append(F.sum(running).alias(f"_after{i + 1}"))
    report = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("join"),
                F.coalesce(F.col(f"_after{i}"), F.lit(0)).alias("rows_before"),
                F.coalesce(F.col(f"_after{i + 1}"), F.lit(0)).alias("rows_after"),
            )
            for i, (name, *_) in enumerate(steps)
        ]
    )
    return rows.agg(*sums).select(F.inline(report))
