"""Declared contracts: column lists and value rules, checked in one pass per table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierloom.functions import parse_json_list, parse_timestamp, strip_ws, to_number

# The contracts name the address format but do not spell it out.
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

# Contract type names, lower case, and their Spark types.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "text": T.StringType(),
    "timestamp": T.TimestampType(),
    "datetime64": T.TimestampType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
    "uint64": T.LongType(),
    "numeric": T.DecimalType(38, 10),
    "float": T.DoubleType(),
    "array": T.ArrayType(T.StringType()),
}

# Python date format parts and their Spark pattern.
FORMAT_PARTS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


class ContractBroken(Exception):
    """The data does not have the columns its contract declares."""


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str = "string"
    nullable: bool = True
    max_length: int | None = None
    format: str | None = None
    pattern: str | None = None
    allowed_values: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None

    @property
    def data_type(self) -> T.DataType:
        name = self.type.strip().lower()
        for wrapper in ("nullable(", "lowcardinality("):
            if name.startswith(wrapper):
                name = name[len(wrapper):-1]
        return TYPES[name]


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ColumnRule, ...]
    primary_key: tuple[str, ...] = ()
    quality_rules: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self) -> T.StructType:
        """Spark schema; the rules of a column travel as its metadata."""
        return T.StructType(
            [
                T.StructField(
                    c.name,
                    c.data_type,
                    c.nullable,
                    {k: v for k, v in vars(c).items() if v not in (None, (), True) and k not in ("name", "nullable")},
                )
                for c in self.columns
            ]
        )


def contract_from(spec: Mapping) -> Contract:
    """Contract from a parsed YAML or JSON document."""
    columns = []
    for entry in spec["columns"]:
        known = {k: v for k, v in entry.items() if k in ColumnRule.__dataclass_fields__}
        known["allowed_values"] = tuple(known.get("allowed_values", ()))
        known.setdefault("nullable", str(entry.get("type", "")).lower().startswith("nullable("))
        columns.append(ColumnRule(**known))
    name = spec.get("table") or spec.get("dataset_name") or "table"
    rules = {r["name"]: tuple(r["columns"]) for r in spec.get("data_quality_rules", ())}
    return Contract(name, tuple(columns), tuple(spec.get("primary_key", ())), rules)


def parse_spec(text: str) -> Mapping:
    """Parsed YAML text, or JSON text where no YAML reader is installed."""
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)


def load_contract(text: str) -> Contract:
    return contract_from(parse_spec(text))


# --- columns ------------------------------------------------------------------------------------------


def check_columns_ordered(df: DataFrame, contract: Contract) -> DataFrame:
    """Stop unless the names are equal and in the same order."""
    if df.columns != contract.names:
        raise ContractBroken(f"expected columns {contract.names}, found {df.columns}")
    return df


def check_columns_set(df: DataFrame, contract: Contract) -> DataFrame:
    """Stop unless the same names occur, in any order."""
    missing = [c for c in contract.names if c not in df.columns]
    extra = [c for c in df.columns if c not in contract.names]
    if missing or extra:
        raise ContractBroken(f"missing columns {missing}, unexpected columns {extra}")
    return df


def type_mismatches(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """Columns whose type is not the declared one: name, declared, found."""
    found = {f.name: f.dataType for f in df.schema.fields}
    return [
        (c.name, c.data_type.simpleString(), found[c.name].simpleString())
        for c in contract.columns
        if c.name in found and found[c.name] != c.data_type
    ]


# --- values -------------------------------------------------------------------------------------------

Rule = tuple[str, str, Column]


def spark_formats(python_format: str) -> list[str]:
    """Spark patterns for a Python date format; ``%z`` takes offsets with and without a colon."""
    pattern = python_format
    for part, spark_part in FORMAT_PARTS.items():
        pattern = pattern.replace(part, spark_part)
    return [pattern.replace("%z", offset) for offset in ("XXX", "XX")] if "%z" in pattern else [pattern]


def _not_null(c: ColumnRule) -> Column | None:
    return None if c.nullable else F.col(c.name).isNull()


def _max_length(c: ColumnRule) -> Column | None:
    return None if c.max_length is None else F.length(c.name) > c.max_length


def _email(c: ColumnRule) -> Column | None:
    return ~F.col(c.name).rlike(EMAIL) if c.format == "email" else None


def _timestamp_format(c: ColumnRule) -> Column | None:
    if not c.format or not isinstance(c.data_type, T.TimestampType):
        return None
    parsed = F.coalesce(*[F.try_to_timestamp(F.col(c.name), F.lit(p)) for p in spark_formats(c.format)])
    return F.col(c.name).isNotNull() & parsed.isNull()


def _pattern(c: ColumnRule) -> Column | None:
    return ~F.col(c.name).rlike(c.pattern) if c.pattern else None


def _array_allowed(c: ColumnRule) -> Column | None:
    """An item outside the list breaks the rule, and so does text that is no array."""
    if not c.allowed_values or not isinstance(c.data_type, T.ArrayType):
        return None
    items = parse_json_list(F.col(c.name))
    extra = F.size(F.array_except(items, F.lit(list(c.allowed_values))))
    return F.col(c.name).isNotNull() & (items.isNull() | (extra > 0))


def _allowed(c: ColumnRule) -> Column | None:
    if not c.allowed_values or isinstance(c.data_type, T.ArrayType):
        return None
    return ~F.col(c.name).isin(*c.allowed_values)


def _range(c: ColumnRule) -> Column | None:
    if c.min_value is None and c.max_value is None:
        return None
    value = to_number(F.col(c.name))
    low = float("-inf") if c.min_value is None else c.min_value
    high = float("inf") if c.max_value is None else c.max_value
    return ~value.between(low, high)


VALUE_RULES = {
    "not_null": _not_null,
    "max_length": _max_length,
    "email_format": _email,
    "timestamp_format": _timestamp_format,
    "pattern": _pattern,
    "array_allowed": _array_allowed,
    "allowed_values": _allowed,
    "range": _range,
}


# Quality rules that repeat what a rule of the column already says, and that rule.
COLUMN_QUALITY_RULES = {"valid_email_format": "email_format", "satisfaction_range": "range"}


def rule_predicates(contract: Contract, only: Sequence[str] = (), now: datetime | None = None) -> list[Rule]:
    """Violation predicate of every declared rule: rule, column, predicate. Null breaks only ``not_null``."""
    rules = [
        (rule, c.name, broken)
        for rule, make in VALUE_RULES.items()
        for c in contract.columns
        if (broken := make(c)) is not None
    ]
    as_of = F.current_timestamp() if now is None else F.lit(now)
    for quality_rule, columns in contract.quality_rules.items():
        for c in columns:
            if quality_rule == "timestamp_in_past":
                rules.append((quality_rule, c, parse_timestamp(F.col(c).cast("string")) >= as_of))
            elif quality_rule == "non_empty_message":
                rules.append(("non_blank", c, strip_ws(F.col(c)) == ""))
            elif quality_rule not in COLUMN_QUALITY_RULES:
                raise ContractBroken(f"unknown quality rule {quality_rule!r}")
            elif not any((rule, column) == (COLUMN_QUALITY_RULES[quality_rule], c) for rule, column, _ in rules):
                raise ContractBroken(f"quality rule {quality_rule!r} needs a {COLUMN_QUALITY_RULES[quality_rule]} rule on column {c!r}")
    return [r for r in rules if not only or r[0] in only]


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule``, ``column``, ``violations``, ``passed`` for every rule, from one pass over the table."""
    counts = df.agg(*[F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"_{i}").alias("violations"))
            for i, (rule, column, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows)).withColumn("passed", F.col("violations") == 0)


def check_primary_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of keys with more than one row, in the form of ``check_rules``."""
    repeated = df.groupBy(*key).count().agg(F.count_if(F.col("count") > 1).alias("violations"))
    return repeated.select(
        F.lit("primary_key").alias("rule"),
        F.lit(",".join(key)).alias("column"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def check_contract(df: DataFrame, contract: Contract, now: datetime | None = None) -> DataFrame:
    """All value rules in one pass, and the key check where a key is declared."""
    out = check_rules(df, rule_predicates(contract, now=now))
    return out.unionByName(check_primary_key(df, contract.primary_key)) if contract.primary_key else out
