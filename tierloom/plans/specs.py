"""Layer steps and checks from YAML and SQL text: a new dataset needs configuration, not code."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tierloom.operators.contracts import parse_spec
from tierloom.operators.quality import Check, not_null
from tierloom.plans import gold, silver
from tierloom.plans.sql_steps import run_query
from tierloom.sources.writers import TransformSpec

# Transforms by the name of the target table; the arguments are the sources.
TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "contact_employments": silver.silver_contact_employments,
    "contact_phones": silver.silver_contact_phones,
    "contacts_by_org": gold.contacts_by_org,
    "contacts_by_occupation": gold.contacts_by_occupation,
    "current_employments": gold.current_employments,
    "contacts_with_phone": gold.contacts_with_phone,
    "contacts_without_phone": gold.contacts_without_phone,
    "phone_type_distribution": gold.phone_type_distribution,
}

# Flags of the processing section, and the argument each one sets.
FLAGS = {
    "contact_employments": {f: f for f in ("deduplicate", "remove_pii_tags", "normalize_occupation")},
    "contact_phones": {
        "deduplicate": "deduplicate",
        "remove_pii_masking": "remove_masked",
        "normalize_phone_numbers": "normalize_phone_numbers",
    },
}

COLUMN_TESTS = {"not_null": not_null}


class SpecBroken(Exception):
    """A specification names something that does not exist."""


def _query(text: str, target: str) -> str:
    """The query over ``{table}``; ``match(text, pattern)`` is ``rlike`` in Spark."""
    named = re.sub(rf"(?<![\\w.]){re.escape(target)}(?![\\w.])", "{table}", text) if target else text
    return re.sub(r"\bmatch\(", "rlike(", named).strip()


def checks_from(spec: Mapping, target: str = "") -> list[Check]:
    """Checks of a parsed document: queries with a condition, and tests by column. ``target`` is the table they name."""
    out = []
    for entry in spec.get("tests") or ():
        if "query" in entry:
            out.append(Check(entry["name"], entry.get("condition", "= 0"), query=_query(entry["query"], target)))
        elif "column" in entry:
            for test in entry.get("tests") or ():
                if test not in COLUMN_TESTS:
                    raise SpecBroken(f"unknown test {test!r} on column {entry['column']!r}")
                out.append(COLUMN_TESTS[test](entry["column"]))
        else:
            raise SpecBroken(f"a test needs a query or a column: {entry}")
    return out


def load_checks(text: str, target: str = "") -> list[Check]:
    return checks_from(parse_spec(text), target)


def _name(entry: Mapping) -> str:
    return f"{entry['database']}.{entry['table']}" if entry.get("database") else entry["table"]


def load_spec(
    text: str,
    tests: str = "",
    locations: Mapping[str, str] | None = None,
    source_formats: Mapping[str, str] | None = None,
    query: str = "",
    **options: object,
) -> TransformSpec:
    """Step from the YAML text of its definition and of its checks, and the SQL text of its query.

    ``source`` is one table or a list of them, in the order of the transform's arguments. Tables are catalog names
    unless ``locations`` gives a path for one. The step runs ``query`` if there is one, else the transform that is
    known for its target. A flag in ``processing`` that the transform does not know stops the loading, as does a flag
    that switches a step of a written query off. ``options`` go to the transform, ``partition_by`` and ``fmt`` to the step.
    """
    spec = parse_spec(text)
    table, target = spec["target"]["table"], _name(spec["target"])
    if (spec.get("transformation") or {}).get("query_file") and not query:
        raise SpecBroken(f"{table!r} needs the text of {spec['transformation']['query_file']!r}; load_step reads it")
    if query:
        off = [f for f, on in (spec.get("processing") or {}).items() if not on]
        if off:
            raise SpecBroken(f"the query of {table!r} does not know flags: {off}")
    elif table not in TRANSFORMS:
        raise SpecBroken(f"no transform makes table {table!r}")
    flags = FLAGS.get(table, {})
    unknown = [f for f in spec.get("processing") or {} if f not in flags]
    if unknown and not query:
        raise SpecBroken(f"unknown processing flags of {table!r}: {unknown}")
    step = {k: options.pop(k) for k in ("partition_by", "fmt") if k in options}
    sources = spec["source"] if isinstance(spec["source"], list) else [spec["source"]]
    place = lambda name: (locations or {}).get(name, name)
    names = [_name(s) for s in sources]
    if query:
        transform = lambda *inputs: run_query(inputs[0].sparkSession, query, dict(zip(names, inputs, strict=True)))
    else:
        switched = {flags[f]: bool(on) for f, on in (spec.get("processing") or {}).items()}
        transform = partial(TRANSFORMS[table], **switched, **options)
    return TransformSpec(
        name=(spec.get("dag") or {}).get("dag_id", table),
        sources={f"source_{i}": place(n) for i, n in enumerate(names)},
        target=place(target),
        transform=lambda **inputs: transform(*inputs.values()),
        checks=load_checks(tests, target) if tests else (),
        source_formats={f"source_{i}": (source_formats or {}).get(n, "parquet") for i, n in enumerate(names)},
        **step,
    )


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def load_step(spark: SparkSession, folder: str, definition: str = "dag.yaml", tests: str = "tests.yaml", **options: object) -> TransformSpec:
    """Step from the files of a folder: its definition, the query file that this names, and its checks if ``tests`` is given."""
    text = _text(spark, f"{folder}/{definition}")
    query_file = (parse_spec(text).get("transformation") or {}).get("query_file")
    query = _text(spark, f"{folder}/{query_file}") if query_file else ""
    return load_spec(text, _text(spark, f"{folder}/{tests}") if tests else "", query=query, **options)
