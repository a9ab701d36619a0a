"""From a declarative spec to one projection, and the split into valid rows and rejects."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import is_blank, merge_text, truncate_chars, uuid5
from tidemark.plans.spec import Copy, Merge, TransformSpec

SOURCE_ID = "_source_id"
ERROR = "_error"


def _input(rows: DataFrame, name: str, strict_nulls: bool) -> Column:
    column = F.col(name)
    if strict_nulls and isinstance(rows.schema[name].dataType, T.StringType):
        return F.coalesce(column, F.raise_error(F.lit(f"null in column {name}")))
    return column


def _output(rows: DataFrame, field: Copy | Merge, strict_nulls: bool) -> Column:
    if isinstance(field, Merge):
        sources = [_input(rows, s, strict_nulls) for s in field.sources]
        value = merge_text(*sources, separator=field.separator)
    else:
        value = _input(rows, field.source, strict_nulls)
    return value if field.max_chars is None else truncate_chars(value, field.max_chars)


def error_column(rows: DataFrame, spec: TransformSpec, strict_nulls: bool = False) -> Column:
    """The reject message of a row, null where the row is valid.

    In this order: no key, a required text that is blank, then for each field a value longer than
    its limit or a missing one that must not be null.  Only limits that a field's own cut does not
    already keep are looked at.
    """
    checks = [
        F.when(
            F.col(spec.key).isNull(), F.lit(f"transform {spec.key}=null: the key is missing")
        )
    ]
    for field in spec.fields:
        if isinstance(field, Merge) and field.required:
            # The merged text is empty when every field is blank, and mostly the first one is not.
            # Fixed value: the wording of this message.
            blank = reduce(and_, [is_blank(_input(rows, s, strict_nulls)) for s in field.sources])
            names = " and ".join(field.sources)
            count = "both" if len(field.sources) == 2 else "all of"
            message = f"transform {spec.key}=%s: {field.output} is empty ({count} {names} are blank)"
            checks.append(
                F.when(blank, F.format_string(message, F.col(spec.key).cast("string")))
            )
    for field in spec.fields:
        value = _output(rows, field, strict_nulls)
        limit = spec.limits.get(field.output)
        problems = []
        if limit is not None and (field.max_chars is None or field.max_chars > limit):
            problems.append((F.length(value) > limit, f"holds more than {limit} characters"))
        if field.output in spec.not_null and not getattr(field, "required", False):
            problems.append((value.isNull(), "has no value"))
        for broken, problem in problems:
            message = f"transform {spec.key}=%s: {field.output} {problem}"
            checks.append(
                F.when(broken, F.format_string(message, F.col(spec.key).cast("string")))
            )
    return F.coalesce(*checks)


def map_rows(
    rows: DataFrame, spec: TransformSpec, strict_nulls: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Target columns of every row, with its source key and its reject message beside them, and
    the columns to ``keep`` of the row.

    Everything is a native column, so the whole step is one projection in generated code.
    """
    if spec.prepare is not None:
        rows = rows.transform(spec.prepare)
    outputs = [_output(rows, f, strict_nulls).alias(f.output) for f in spec.fields]
    return rows.select(
        F.col(spec.key).alias(SOURCE_ID),
        error_column(rows, spec, strict_nulls).alias(ERROR),
        uuid5(F.col(spec.key).cast("string"), spec.namespace).alias(spec.key_output),
        *outputs,
        *keep,
    )


def valid_rows(mapped: DataFrame, spec: TransformSpec) -> DataFrame:
    return mapped.where(F.col(ERROR).isNull()).select(*spec.target_columns())


def rejected_rows(mapped: DataFrame, id_name: str = "id") -> DataFrame:
    """The quarantine: source key and message of every row that failed."""
    return mapped.where(F.col(ERROR).isNotNull()).select(
        F.col(SOURCE_ID).alias(id_name), F.col(ERROR).alias("error")
    )


def surviving_source_rows(rows: DataFrame, spec: TransformSpec) -> DataFrame:
    """Source rows that pass; the check travels with the row, so no join is needed."""
    return rows.where(error_column(rows, spec).isNull())
