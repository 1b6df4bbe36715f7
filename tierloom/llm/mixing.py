"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates between 0 and ``most`` whose
tokens add up to each source's target, those of least entropy relative to one copy each are exponential tilts:
odds of the rate grow with exp(lambda * size). One lambda per source solves the convex dual; Newton steps find
it, each a distributed sum of tokens and of their derivative over a table already reduced to (source, size,
number of documents). Rates are then rounded to whole copies in groups of bounded size, in falling order of
document size, each document taking over what the rounding before it left: a group misses its sum by no more
than about half of its smallest document.

The numbers per source, not per document, pass the driver.

Defined results: a null text has size 0 and is never taken; null is a source of its own, the last in order.
A source of size 0 has target 0. Repeated rows are documents of their own. An empty table gives no rows.
Extra columns are ignored. The same table gives the same mix on every run.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierloom.llm.shared import WORD, in_file_order, store, unused

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
# Documents rounded together.
GROUP = 4096
STEPS = 60
PRECISION = 1e-7


def targets(sizes: Mapping[str | None, int], weights: Sequence[float] = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """Target of each source: weights in code point order of names, null last; none above ``most`` times its size."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, list(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {s: (out | share)[s] for s in order}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
        left = max(left, 0.0)
    return {s: out[s] for s in order}


def _rate(tilt: Column, size: Column, most: int) -> Column:
    """Rate between 0 and ``most``, 1 without a tilt."""
    return most / (1 + (most - 1) * F.exp(-tilt * size))


def tilts(histogram: DataFrame, goal: Mapping[str | None, float], sizes: Mapping[str | None, int], mean: Mapping[str | None, float], most: int = MOST) -> dict[str | None, float]:
    """Lambda of each source by safeguarded Newton steps on the dual; infinite where the target is at its bound."""
    found = {s: (math.inf if goal[s] >= most * sizes[s] * (1 - PRECISION) else -math.inf if goal[s] <= 0 else 0.0) for s in goal}
    low = {s: -math.inf for s in goal}
    high = {s: math.inf for s in goal}
    open_ = [s for s in goal if math.isfinite(found[s]) and sizes[s]]
    for _ in range(STEPS):
        if not open_:
            break
        now = _per_source(histogram, {s: (found[s] / mean[s],) for s in open_}, "tilt double")
        rate = _rate(F.col("tilt"), F.col("size"), most)
        slope = rate * (1 - rate / most)
        tokens = F.col("size") * F.col("n")
        sums = now.groupBy("source").agg(F.sum(tokens * rate).alias("got"), F.sum(tokens * F.col("size") * slope).alias("slope")).collect()
        for s, got, slope_sum in sums:
            miss = got - goal[s]
            if abs(miss) <= PRECISION * goal[s]:
                open_.remove(s)
                continue
            low, high = (low | {s: found[s]}, high) if miss < 0 else (low, high | {s: found[s]})
            step = found[s] - miss / (slope_sum / mean[s]) if slope_sum > 0 else math.nan
            if not low[s] < step < high[s]:
                step = (low[s] + high[s]) / 2 if math.isfinite(low[s] + high[s]) else 2 * found[s] + (1 if miss < 0 else -1)
            if step in (low[s], high[s]):
                open_.remove(s)
                continue
            found[s] = step
    return {s: (v / mean[s] if math.isfinite(v) and mean[s] else v) for s, v in found.items()}


def _per_source(df: DataFrame, values: Mapping[str | None, tuple], schema: str) -> DataFrame:
    """Inner join of numbers per source; the table is broadcast unless there are very many sources."""
    table = df.sparkSession.createDataFrame([(s, *v) for s, v in values.items()], f"_source string, {schema}")
    table = F.broadcast(table) if len(values) <= 100_000 else table
    return df.join(table, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    id_col: str = "doc_id",
    text: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row: ``at`` (place in the scan), ``id``, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``."""
    rows = in_file_order(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{text}`").alias("text")))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    dealt = F.xxhash64("id", F.crc32(F.col("text").cast("binary")), size)
    sized = store(rows.select(F.monotonically_increasing_id().alias("at"), "id", "source", size.alias("size"), dealt.alias("dealt")), "sized")

    histogram = store(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    facts = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).collect()
    sizes, count = {r["source"]: r["size"] for r in facts}, {r["source"]: r["n"] for r in facts}
    goal = targets(sizes, weights, most)
    tilt = tilts(histogram.where("size > 0"), goal, sizes, {s: sizes[s] / count[s] for s in sizes}, most)

    facts = {s: (sizes[s], goal[s], min(max(tilt[s], -1e300), 1e300), -(-count[s] // GROUP)) for s in sizes}
    known = _per_source(sized, facts, "source_size long, target double, tilt double, parts int")
    exponent = F.when(F.col("tilt") >= 1e300, F.lit(float(most))).when(F.col("tilt") <= -1e300, F.lit(0.0)).otherwise(_rate(F.col("tilt"), F.col("size"), most))
    rated = known.withColumn("rate", F.when(F.col("size") > 0, exponent).otherwise(0.0)).withColumn("part", F.pmod("dealt", F.col("parts")))
    held = rated.select("source", "part", "at", "id", "size", "source_size", "target", "rate", "dealt")

    def rounded(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("dealt", "ascending"), ("at", "ascending")])
        carry, copies = 0.0, []
        for words, rate in zip(group["size"].to_pylist(), group["rate"].to_pylist(), strict=True):
            want = words * rate + carry
            taken = min(most, max(0, math.floor(want / words + 0.5))) if words else 0
            carry = want - taken * words
            copies.append(taken)
        return group.drop_columns(["part", "dealt"]).append_column("copies", pa.array(copies, pa.int32()))

    key = docs.schema[id_col].dataType.simpleString()
    schema = f"source string, at long, id {key}, size long, source_size long, target double, rate double, copies int"
    return held.groupBy("source", "part").applyInArrow(rounded, schema)


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, **columns: str) -> DataFrame:
    """The documents of the mix, all columns kept; a document taken more than once is that many rows."""
    source = in_file_order(docs)
    at, copies = unused(docs, "_at"), unused(docs, "_copies")
    taken = mix(source, weights, most, **columns).where("copies > 0").select(F.col("at").alias(at), F.col("copies").alias(copies))
    met = source.withColumn(at, F.monotonically_increasing_id()).join(taken, at)
    return met.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[f"`{c}`" for c in docs.columns])
