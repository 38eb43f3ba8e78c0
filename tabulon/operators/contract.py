"""L1 + L2 — a closed request contract: JSON requests against required fields, closed sets and routing rules.

A request is parsed once as VARIANT, so that what it holds beside the contract is seen too:
unknown fields are found in the value, missing ones are told from null ones, and a number is
not taken for its text. Every check is a projection on the row; nothing is shuffled.

Errors are (field, message, type), in this order: a body that is no JSON object (one error
under ``body``); fields in the contract's order (``missing``, ``enum``); unknown fields by
name (``extra_forbidden``). Routing rules are looked at only where the fields are in order,
and the first one broken is reported (``value_error``). Values are trimmed before they are
looked up; a null, a blank or another type than text is outside every closed set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.exprs import trim_ws
from tabulon.session import written


def _error(field: Column | str, message: str, kind: str) -> Column:
    return F.struct((F.lit(field) if isinstance(field, str) else field).alias("field"), F.lit(message).alias("message"), F.lit(kind).alias("type"))


def parsed(df: DataFrame, body: str, fields: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, one trimmed text column per field, and ``errors``: all that the fields alone can show.

    Fields are looked up one by one in compiled code; lists are gone through, which Spark
    interprets, only for requests with errors. The steps stay apart, since each refers to
    columns of the one before more than once. The second makes the list of unknown fields,
    so Spark compiles it in short methods (one long method would not be compiled by the JVM).
    """
    v = df.select(*keep, F.try_parse_json(body).alias("__v"))
    v = v.select(*keep, F.expr("try_variant_get(__v, '$', 'map<string, variant>')").alias("__m"))
    known = F.array(*[F.lit(f) for f in fields])
    extra = F.transform(F.array_sort(F.array_except(F.map_keys("__m"), known)), lambda n: _error(n, "Extra inputs are not permitted", "extra_forbidden"))
    found = []
    for i, (f, values) in enumerate(fields.items()):
        value = F.try_element_at("__m", F.lit(f))
        text = F.when(F.schema_of_variant(value) == "STRING", trim_ws(value.cast("string")))
        found += [value.isNotNull().alias(f"__there{i}"), text.alias(f"__text{i}"), F.coalesce(text.isin(*values), F.lit(False)).alias(f"__ok{i}")]
    v = v.select(*keep, F.col("__m").isNull().alias("__none"), *found, extra.alias("__extra"))
    wrong = [F.when(~F.col(f"__ok{i}"), F.when(F.col(f"__there{i}"), _error(f, "Input should be one of the allowed categories", "enum"))
                    .otherwise(_error(f, "Field required", "missing"))) for i, f in enumerate(fields)]
    in_order = F.lit(True)
    for i in range(len(wrong)):
        in_order = in_order & F.col(f"__ok{i}")
    no_object = F.array(_error("body", "Input should be a valid JSON object", "object_type"))
    errors = F.when(F.col("__none"), no_object).when(in_order, F.col("__extra")).otherwise(F.concat(F.array_compact(F.array(*wrong)), F.col("__extra")))
    return v.select(*keep, *[F.col(f"__text{i}").alias(f) for i, f in enumerate(fields)], errors.alias("errors"))


def routed(df: DataFrame, rules: Sequence[tuple[Column, str, str]]) -> DataFrame:
    """``errors`` of rows whose fields are in order: the first routing rule that is broken."""
    first = F.coalesce(*[F.when(F.coalesce(cond, F.lit(False)), _error(field, message, "value_error")) for cond, field, message in rules])
    return df.withColumn("errors", F.when(F.size("errors") == 0, F.array_compact(F.array(first))).otherwise(F.col("errors")))


def checked(df: DataFrame, body: str, fields: Mapping[str, Sequence[str]], rules: Sequence[tuple[Column, str, str]], keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted requests as typed columns, rejected ones as ``keep`` and ``errors``); requests are parsed once for both and written."""
    out = written(routed(parsed(df, body, fields, keep), rules), "checked")
    return out.filter(F.size("errors") == 0).drop("errors"), out.filter(F.size("errors") > 0).select(*keep, "errors")
