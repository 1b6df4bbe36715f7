"""Layer steps written as SQL text over named tables, in the dialect such files are kept in.

The dialect's functions that Spark lacks are SQL functions of the session, made of Spark's own: the optimizer inlines
their bodies, so a step from text has the plan of a step from DataFrame code.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Names and arguments of the dialect's functions, with what they mean in Spark SQL.
FUNCTIONS = {
    "trimBoth": ("s STRING", "STRING", "trim(s)"),
    "trimLeft": ("s STRING", "STRING", "ltrim(s)"),
    "trimRight": ("s STRING", "STRING", "rtrim(s)"),
    "toString": ("s STRING", "STRING", "s"),
    "lowerUTF8": ("s STRING", "STRING", "lower(s)"),
    "upperUTF8": ("s STRING", "STRING", "upper(s)"),
    # A group is \1 in the dialect and $1 in Spark, where a plain dollar sign has to be escaped.
    "replaceRegexpAll": (
        "s STRING, pattern STRING, other STRING",
        "STRING",
        r"regexp_replace(s, pattern, regexp_replace(replace(other, '$', r'\$'), r'\\([0-9])', r'\$$1'))",
    ),
    "replaceAll": ("s STRING, part STRING, other STRING", "STRING", "replace(s, part, other)"),
    "match": ("s STRING, pattern STRING", "BOOLEAN", "rlike(s, pattern)"),
    "empty": ("s STRING", "BOOLEAN", "s = ''"),
    "notEmpty": ("s STRING", "BOOLEAN", "s <> ''"),
    "toDateOrNull": ("s STRING", "DATE", "try_to_date(s)"),
    "toDateTimeOrNull": ("s STRING", "TIMESTAMP", "try_to_timestamp(s)"),
    "toInt64OrNull": ("s STRING", "BIGINT", "try_cast(s AS BIGINT)"),
    "toFloat64OrNull": ("s STRING", "DOUBLE", "try_cast(s AS DOUBLE)"),
}

# Quoted text and comments, which hold no table names.
_APART = re.compile(r"('(?:[^'\\]|\\.|'')*'|--[^\n]*|/\*.*?\*/)", re.DOTALL)


class QueryBroken(Exception):
    """The text of a step is no single query, or names what does not exist."""


def define_functions(spark: SparkSession) -> None:
    """Make the dialect's functions known to the session."""
    for name, (arguments, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")


def _mention(table: str) -> re.Pattern:
    return re.compile(rf"(?<![\w.`]){re.escape(table)}(?![\w`])")


def run_query(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Result of one query over tables named as in ``tables``, such as ``silver.contacts``.

    A column named with its whole table (``silver.contacts.id``) is understood as well. Anything but one query is
    refused before it reaches Spark, which would run a command at once.
    """
    pieces = _APART.split(text)
    code = " ".join(p for p in pieces[::2]).strip().rstrip(";").strip()
    if not re.match(r"(?i)(select|with|\()", code) or ";" in code:
        raise QueryBroken(f"a step is one query: {text.strip()[:80]!r}")
    names = {table: f"step_input_{i}" for i, table in enumerate(tables)}
    for table, name in names.items():
        pieces[::2] = [_mention(table).sub(name, p) for p in pieces[::2]]
    named = "".join(pieces).strip().rstrip(";")
    define_functions(spark)
    try:
        for table, name in names.items():
            tables[table].createOrReplaceTempView(name)
        return spark.sql(named)
    except AnalysisException as error:
        parameters = error.getMessageParameters() or {}
        missing = {"UNRESOLVED_ROUTINE": "routineName", "TABLE_OR_VIEW_NOT_FOUND": "relationName"}.get(error.getCondition())
        if missing:
            raise QueryBroken(f"not known: {parameters[missing].replace('`', '')}") from error
        raise
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)
