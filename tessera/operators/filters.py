"""Row filters: truthiness, primes, prefixes of a sequence, batch gates, URL policy."""

from __future__ import annotations

import ipaddress
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordering import join_on_keys, order_names


def truthy(df: DataFrame, name: str) -> Column:
    """True for a value that is neither NULL nor zero, empty or false (P-10)."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        test = col != ""
    elif isinstance(kind, T.BooleanType):
        test = col
    elif isinstance(kind, T.NumericType):
        test = col != 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(col) > 0
    elif isinstance(kind, T.BinaryType):
        test = F.length(col) > 0
    else:
        test = col.isNotNull()
    return F.coalesce(test, F.lit(False))


def is_prime(n: Column) -> Column:
    """Trial division by 2 and the odd numbers up to the root (P-12)."""
    odd = F.sequence(F.lit(3).cast("bigint"), F.greatest(F.floor(F.sqrt(n)), F.lit(3)), F.lit(2).cast("bigint"))
    return (F.when(n < 2, False).when(n < 4, True).when(n % 2 == 0, False)
            .otherwise(F.forall(odd, lambda d: (n % d != 0) | (d == n))))


def parity(n: Column) -> Column:
    """0 for even, 1 for odd, also below zero (P-11)."""
    return F.pmod(n, F.lit(2))


def _before_first_failure(df: DataFrame, keys: Sequence[str], order: Sequence[str], passes: Column) -> DataFrame:
    names = order_names(order)
    if any(o.startswith("-") for o in order):
        raise ValueError("take_while and drop_while need an ascending order")
    rank = F.struct(*names)
    fails = ~F.coalesce(passes, F.lit(False))
    first = (df.filter(fails).groupBy(*keys).agg(F.min(rank).alias("__first")) if keys
             else df.agg(F.min(F.when(fails, rank)).alias("__first")))
    return join_on_keys(df, first, keys).withColumn("__rank", rank)


def take_while(df: DataFrame, keys: Sequence[str], order: Sequence[str], passes: Column) -> DataFrame:
    """Rows of each key before the first one that fails (P-16).

    The first failure is a map-side combined minimum, so no group is sorted.
    ``order`` must be unique within the key and hold no NULLs.
    """
    rows = _before_first_failure(df, keys, order, passes)
    return rows.filter(F.col("__first").isNull() | (F.col("__rank") < F.col("__first"))).drop("__first", "__rank")


def drop_while(df: DataFrame, keys: Sequence[str], order: Sequence[str], passes: Column) -> DataFrame:
    """The rest of each key, from its first failing row on (P-16)."""
    rows = _before_first_failure(df, keys, order, passes)
    return rows.filter(F.col("__rank") >= F.col("__first")).drop("__first", "__rank")


def unique_first(df: DataFrame, items: Sequence[str], position: str) -> DataFrame:
    """First occurrence of each item by position (P-14): a combined minimum, no sort."""
    rest = [c for c in df.columns if c not in items and c != position]
    packed = df.groupBy(*items).agg(F.min(F.struct(position, *rest)).alias("__row"))
    return packed.select(*[F.col(c) if c in items else F.col(f"__row.{c}").alias(c) for c in df.columns])


def gate_batches(df: DataFrame, batch: Sequence[str], valid: Column) -> DataFrame:
    """Rows of those batches in which every row is valid (P-17)."""
    bad = df.filter(~F.coalesce(valid, F.lit(False))).select(*[F.col(b).alias(f"__b_{b}") for b in batch]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__b_{b}")) for b in batch])
    return df.join(bad, same, "left_anti")


CSV_RULE = (lambda line: F.contains(line, F.lit(",")), F.upper)
JSON_RULE = (lambda line: F.startswith(F.trim(line), F.lit("{")),
             lambda line: F.replace(line, F.lit("{"), F.lit("{\n  ")))


def process_lines(df: DataFrame, batch: Sequence[str], line: str, rule) -> tuple[DataFrame, DataFrame]:
    """Gate a batch of lines, rewrite the accepted ones and count what was saved."""
    test, rewrite = rule
    kept = gate_batches(df, batch, test(F.col(line))).withColumn(line, rewrite(F.col(line)))
    return kept, kept.groupBy(*batch).agg(F.count(F.lit(1)).alias("saved"))


def matches(criteria: dict[str, object]) -> Column:
    """Conjunction of equality tests; a list means membership, a pair ``("<=", v)`` a comparison."""
    tests = []
    for name, want in criteria.items():
        col = F.col(name)
        if isinstance(want, list):
            tests.append(col.isin(want))
        elif isinstance(want, tuple):
            op, value = want
            tests.append({"<": col < value, "<=": col <= value, ">": col > value,
                          ">=": col >= value, "!=": col != value}[op])
        else:
            tests.append(col == want)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


# Hosts and address blocks a fetched URL may not point to.
BLOCKED_HOSTS = ["169.254.169.254", "metadata.google.internal"]
PRIVATE_V4 = ["0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24",
              "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24",
              "240.0.0.0/4"]


def _v4_number(host: Column) -> Column:
    parts = F.split(host, r"\.")
    return reduce(lambda a, b: a * 256 + b, [parts[i].cast("bigint") for i in range(4)])


def url_verdict(df: DataFrame, url: str, compat: bool = False, name: str = "verdict") -> DataFrame:
    """``ok`` or the reason to refuse a URL (P-18).

    ``compat`` lets private addresses pass.
    """
    parts = F.regexp_extract
    rest = F.col(url)
    authority = F.regexp_replace(parts(rest, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), "^.*@", "")
    in_brackets = parts(authority, r"^\[([^\]]*)\]", 1)
    rows = (df.withColumn("__scheme", F.lower(parts(rest, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)))
              .withColumn("__v6", in_brackets)
              .withColumn("__host", F.lower(F.regexp_replace(authority, r":\d*$", ""))))
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    is_v4 = F.col("__host").rlike(rf"^{octet}(\.{octet}){{3}}$")
    number = _v4_number(F.col("__host"))
    nets = [ipaddress.ip_network(n) for n in PRIVATE_V4]
    inside = reduce(lambda a, b: a | b, [number.between(int(n.network_address), int(n.broadcast_address))
                                         for n in nets])
    private = F.when(is_v4, inside).otherwise(False)
    base = (F.when(~F.col("__scheme").isin("https"), "scheme")
             .when(F.col("__host").isin(BLOCKED_HOSTS), "host"))

    def done(part: DataFrame, is_private: Column) -> DataFrame:
        blocked = F.lit(False) if compat else is_private
        return (part.withColumn(name, base.when(blocked, "private").otherwise("ok"))
                    .drop("__scheme", "__v6", "__host", "__inner"))

    @F.pandas_udf("boolean")
    def inner_v6(hosts: pd.Series) -> pd.Series:
        def check(h):
            try:
                ip = ipaddress.ip_address(h)
            except ValueError:
                return False
            return ip.is_private or ip.is_loopback or ip.is_link_local
        return hosts.map(check)

    names = done(rows.filter((F.col("__v6") == "") | F.col("__v6").isNull()), private)
    sixes = rows.filter(F.col("__v6") != "").withColumn("__inner", inner_v6("__v6"))
    return names.unionByName(done(sixes, F.col("__inner")))
