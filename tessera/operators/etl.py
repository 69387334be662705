"""Row-level cleaning, validation with reasons, guarded and memoised maps."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numbers import grade
from tessera.functions.strings import strip, title_case
from tessera.operators.ordering import number_rows


def upload_rows(df: DataFrame) -> DataFrame:
    """Rows with an address: email lower-cased and stripped, name in title case or '' (E-1)."""
    return (df.filter(F.coalesce(F.col("email").contains("@"), F.lit(False)))
            .select(strip(F.lower("email")).alias("email"),
                    title_case(F.coalesce("name", F.lit(""))).alias("name")))


class Rule:
    """A named test; NULL counts as failed."""

    def __init__(self, field: str, message: str, test: Column):
        self.field, self.message, self.test = field, message, test

    def error(self) -> Column:
        return F.when(~F.coalesce(self.test, F.lit(False)), F.struct(
            F.lit(self.field).alias("field"), F.lit(self.message).alias("message")))


# Fixed value: pattern of an accepted address.
EMAIL = r"^[\w.+-]+@[\w-]+\.[a-z]{2,}$"


def signup_rules() -> tuple[list[Rule], list[Rule]]:
    """Field rules and the rules checked once all fields pass (E-2)."""
    name, email, age = F.col("name"), F.col("email"), F.col("age")
    fields = [Rule("name", "2 to 50 characters", F.length(name).between(2, 50)),
              Rule("email", "not an address", email.rlike("(?U)" + EMAIL)),
              Rule("age", "between 0 and 120", age.between(0, 120)),
              Rule("password", "missing", F.col("password").isNotNull())]
    return fields, [Rule("age", "must be 18 or older", age >= 18)]


def validate(df: DataFrame, fields: Sequence[Rule], whole: Sequence[Rule] = (), name: str = "errors") -> DataFrame:
    """Add the list of broken rules; whole-row rules apply when all fields pass (E-2)."""
    none = F.array().cast("array<struct<field:string,message:string>>")
    first = F.array_compact(F.array(*[x.error() for x in fields])) if fields else none
    second = F.array_compact(F.array(*[x.error() for x in whole])) if whole else none
    return (df.withColumn("__first", first)
            .withColumn(name, F.when(F.size("__first") > 0, F.col("__first")).otherwise(second)).drop("__first"))


def accept_reject(df: DataFrame, fields: Sequence[Rule], whole: Sequence[Rule] = ()) -> tuple[DataFrame, DataFrame]:
    checked = validate(df, fields, whole)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def signup(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows with a normalised address, and rejects with reasons (E-2)."""
    good, bad = accept_reject(df, *signup_rules())
    return good.withColumn("email", strip(F.lower("email"))), bad


def graded_people(df: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Adults with a grade, sorted by score from the top, as one line each (E-3)."""
    rows = df.filter(F.col("age") >= 25).withColumn("grade", grade(F.col("score")))
    line = F.format_string("%s (%s) - Grade %s - %s", F.col("name"), F.col("age").cast("string"), F.col("grade"), F.col("city"))
    return number_rows(rows, [], ["-score", "name"], "pos", hot_rows).withColumn("line", line)


def guard_chain(df: DataFrame, checks: Sequence[tuple[int, Column]], name: str = "code") -> DataFrame:
    """Code of the first failing check, 200 when all pass (E-4)."""
    code = F.lit(200)
    for value, passes in reversed(checks):
        code = F.when(~F.coalesce(passes, F.lit(False)), value).otherwise(code)
    return df.withColumn(name, code)


# Code and status of each class of failure.
ERROR_CLASSES = {"not_found": 404, "conflict": 409, "validation_error": 422, "external_service_error": 502,
                 "internal_error": 500}


def error_envelope(kind: Column, message: Column, details: Column | None = None) -> Column:
    """``status, code, http, message, details`` of a failure; an unknown class is an internal error (E-5).

    ``details`` is a map of texts, empty when none is given.
    """
    nothing = F.create_map().cast("map<string,string>")
    more = nothing if details is None else F.coalesce(details, nothing)

    def build(key):
        return F.struct(F.lit("error").alias("status"), F.lit(key).alias("code"),
                        F.lit(ERROR_CLASSES[key]).alias("http"), message.alias("message"), more.alias("details"))

    out = build("internal_error")
    for key in ERROR_CLASSES:
        if key != "internal_error":
            out = F.when(kind == key, build(key)).otherwise(out)
    return out


def filter_batches(df: DataFrame, keep: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Iterator of frames in, filtered frames of the same schema out (E-6, U-5)."""

    def run(frames):
        for frame in frames:
            yield frame[keep(frame)]

    return df.mapInPandas(run, df.schema)


def map_rows(df: DataFrame, columns: Sequence[str], fn: Callable, returns: str, name: str = "result") -> DataFrame:
    """Apply a Python function to one or more columns (E-7, E-8, E-11).

    Rows keep their key and order columns, so results are matched by key
    whatever task made them.
    """

    @F.pandas_udf(returns)
    def apply(*series: pd.Series) -> pd.Series:
        return pd.Series([fn(*values) for values in zip(*series)], index=series[0].index)

    return df.withColumn(name, apply(*columns))


def retry(fn: Callable, attempts: int = 3, delay: float = 0.0, give_up: str = "raise") -> Callable:
    """Up to ``attempts`` calls with a pause; then the last error, or None (E-10)."""

    def wrapped(*args):
        failure = None
        for pause in [0.0, *[delay] * (attempts - 1)]:
            if pause:
                time.sleep(random.uniform(pause, 1.1 * pause))
            try:
                return fn(*args)
            except Exception as error:  # noqa: BLE001
                failure = error
        if give_up == "raise" and failure is not None:
            raise failure
        return None

    return wrapped


def map_captured(df: DataFrame, columns: Sequence[str], fn: Callable, returns: str, on_error: str = "capture",
                 attempts: int = 1, delay: float = 0.0, name: str = "outcome") -> DataFrame:
    """Apply a function; a failing row yields its error text and stops nothing (E-9).

    The new column is ``struct<result, error>``. ``on_error="raise"`` fails
    the job; ``attempts`` retries a row first (E-10).
    """
    call = retry(fn, attempts, delay) if attempts > 1 else fn
    kind = T._parse_datatype_string(returns) if isinstance(returns, str) else returns
    out = T.StructType([T.StructField("result", kind), T.StructField("error", T.StringType())])

    @F.pandas_udf(out)
    def apply(*series: pd.Series) -> pd.DataFrame:
        results, errors = [], []
        for values in zip(*series):
            try:
                results.append(call(*values))
                errors.append(None)
            except Exception as e:  # noqa: BLE001
                if on_error == "raise":
                    raise
                results.append(None)
                errors.append(str(e))
        return pd.DataFrame({"result": pd.Series(results, dtype=object), "error": pd.Series(errors, dtype=object)})

    return df.withColumn(name, apply(*columns))


def memoised(df: DataFrame, arguments: Sequence[str], compute: Callable[[DataFrame], DataFrame],
             ignore: Sequence[str] = ()) -> DataFrame:
    """Compute once per distinct argument and join back (E-12).

    ``compute`` maps the distinct arguments to the same columns plus results.
    Columns in ``ignore`` are arguments that do not belong to the key.
    """
    key = [a for a in arguments if a not in ignore]
    results = compute(df.select(*key).distinct())
    renamed = results.select(*[F.col(k).alias(f"__k_{k}") for k in key], *[c for c in results.columns if c not in key])
    same = None
    for k in key:
        test = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        same = test if same is None else same & test
    return df.join(renamed, same).drop(*[f"__k_{k}" for k in key])
