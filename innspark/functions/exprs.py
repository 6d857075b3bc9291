"""Reusable column expressions and small DataFrame combinators.

All of them compile to built-in Spark expressions (no Python UDFs), so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """Division that yields null on a zero/null denominator (BigQuery SAFE_DIVIDE)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def median(c) -> Column:
    """Approximate median (percentile_approx at 0.5): partial-aggregatable sketch."""
    return F.percentile_approx(col(c), 0.5)


def exact_avg(c, digits: int = 12) -> Column:
    """Average of doubles summed in 1e-``digits`` fixed point, so that it doesn't depend
    on the order in which rows are added (engine, partitioning, retries)."""
    fixed = F.round(col(c).cast("double") * 10.0 ** digits).cast("decimal(38,0)")
    return F.try_divide(F.sum(fixed).cast("double"), F.count(fixed)) / 10.0 ** digits


def exact_avg_sql(c: str, digits: int = 12) -> str:
    """DuckDB text of ``exact_avg``."""
    return f"cast(sum(cast(round({c} * 1e{digits}) AS DECIMAL(38,0))) AS double) / nullif(count({c}), 0) / 1e{digits}"


def ranged_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``df`` ranged and sorted by key and order, equal ones by a hash of the row, as a
    table; __part is a row's range, __id counts up within it. No range holds a key that
    has more rows than others."""
    import uuid

    from innspark.session import scratch_dir
    spark = df.sparkSession
    tie = F.xxhash64(*df.columns).alias("__tie")
    ranged = (df.select("*", tie).repartitionByRange(*keys, order, "__tie")
              .sortWithinPartitions(*keys, order, "__tie")
              .withColumn("__id", F.monotonically_increasing_id()).drop("__tie"))
    path = scratch_dir(spark, f"numbered-{uuid.uuid4().hex}")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path).withColumn("__part", F.shiftright(F.col("__id"), 33))


def numbered_rows(df: DataFrame, keys: list[str], order: str, position: str = "__pos") -> DataFrame:
    """``df`` with each row's place (from 0) in its ``keys`` by ``order``: its place in its
    range after the sum of the ranges before. One shuffle of the rows, and no task holds
    a key. Nulls in ``keys`` are a key."""
    table = ranged_rows(df, keys, order)
    held = table.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    # a key has as many rows here as ranges that hold it
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(*keys, "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    placed = null_safe_join(table, starts, [*keys, "__part"], "inner")
    return placed.withColumn(position, F.col("__start") + F.col("__id") - F.col("__first")).drop(
        "__id", "__part", "__first", "__start")


def exact_percentiles(values: DataFrame, keys: list[str], value: str, ps: list[float]) -> DataFrame:
    """(keys, n, percentiles): exact interpolated percentiles of ``value`` by
    ``keys``, distributed.

    Equal values are counted first. Those counts are ranged by key and value over
    the partitions, and running sums within a partition start at the sum of the
    partitions before it, so no task holds a column. ``percentiles`` is an array in
    the order of ``ps``; nulls are left out."""
    return percentiles_of(counted_values(values, keys, value), keys, ps)


def counted_values(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n, part) as a table: each value's count, ranged over ``part``."""
    import uuid

    from innspark.session import scratch_dir
    spark = values.sparkSession
    counted = (values.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value"))
               .agg(F.count(F.lit(1)).alias("n")))
    ranged = counted.repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id())
    path = scratch_dir(spark, f"values-{uuid.uuid4().hex}")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def percentiles_of(counted: DataFrame, keys: list[str], ps: list[float]) -> DataFrame:
    by_part = counted.groupBy(*keys, "part").agg(F.sum("n").alias("in_part"))
    # as many rows as partitions for each key
    order = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select(*keys, "part", F.coalesce(F.sum("in_part").over(order), F.lit(0)).alias("start"),
                            F.sum("in_part").over(Window.partitionBy(*keys)).alias("total"))
    running = F.sum("n").over(Window.partitionBy(*keys, "part").orderBy("value")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (counted.join(starts, [*keys, "part"]).withColumn("upto", F.col("start") + running)
              .withColumn("from", F.col("upto") - F.col("n")))
    at = [(F.col("total") - 1) * p for p in ps]
    here = lambda k: (F.col("from") <= k) & (k < F.col("upto"))
    out = ranked.groupBy(*keys).agg(
        F.max("total").alias("n"),
        *[F.max(F.when(here(F.floor(a)), F.col("value"))).cast("double").alias(f"__lo{i}") for i, a in enumerate(at)],
        *[F.max(F.when(here(F.ceil(a)), F.col("value"))).cast("double").alias(f"__hi{i}") for i, a in enumerate(at)])
    part = [(F.col("n") - 1) * p - F.floor((F.col("n") - 1) * p) for p in ps]
    return out.select(*keys, "n", F.array(*[
        F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * x for i, x in enumerate(part)]
    ).alias("percentiles"))


def parse_mixed_date(c) -> Column:
    """B3: 'dd/MM/yyyy' when the text holds a '/', ISO otherwise."""
    c = col(c)
    return F.when(c.contains("/"), F.to_date(c, "dd/MM/yyyy")).otherwise(F.to_date(c, "yyyy-MM-dd"))


PHONE_DOMESTIC = r"^(\+?62|0)8[0-9]{8,11}$"


def normalize_phone(c) -> Column:
    """Strip spaces/dashes; domestic numbers are rewritten to a leading 0,
    anything else keeps its original text."""
    c = col(c)
    digits = F.regexp_replace(c, r"[\s\-]", "")
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(~digits.rlike(PHONE_DOMESTIC), c)
            .when(digits.startswith("+62"), F.concat(F.lit("0"), F.substring(digits, 4, 1 << 30)))
            .when(digits.startswith("62"), F.concat(F.lit("0"), F.substring(digits, 3, 1 << 30)))
            .otherwise(digits))


# Fixed value: BigQuery INITCAP's default word delimiters (whitespace plus
# this punctuation set).
INITCAP_DELIMITERS = " \t\n\r[](){}<>/-_*+,.;:!?@#$%^&|'\"=~"
_DELIM_CLASS = "[" + "".join("\\" + ch if ch in "[]^\\-" else ch for ch in INITCAP_DELIMITERS) + "]"


def initcap_words(c) -> Column:
    """Title case where a word starts after any default delimiter, not only
    after a space (Spark's initcap). Built from substr/upper/lower over the
    character positions, no UDF."""
    s = col(c)
    n = F.length(s)
    chars = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.when((i == 1) | s.substr(i - 1, F.lit(1)).rlike(_DELIM_CLASS),
                         F.upper(s.substr(i, F.lit(1)))).otherwise(F.lower(s.substr(i, F.lit(1)))))
    return F.when(s.isNull(), F.lit(None).cast("string")).when(n == 0, s).otherwise(F.array_join(chars, ""))


def initcap_sql(expr: str) -> str:
    """DuckDB text of ``initcap_words`` for the oracle."""
    cls = _DELIM_CLASS.replace("'", "''")
    return (f"CASE WHEN ({expr}) IS NULL THEN NULL WHEN length({expr}) = 0 THEN ({expr}) ELSE "
            f"array_to_string(list_transform(range(1, length({expr}) + 1), "
            f"lambda i: CASE WHEN i = 1 OR regexp_matches(substr({expr}, i - 1, 1), '{cls}') "
            f"THEN upper(substr({expr}, i, 1)) ELSE lower(substr({expr}, i, 1)) END), '') END")


def minute_of_day(c) -> Column:
    """Minute of the day of an 'HH:mm:ss' text (TIME columns are stored as text)."""
    c = col(c)
    return F.substring(c, 1, 2).cast("int") * 60 + F.substring(c, 4, 2).cast("int")


def minute_diff(end, start) -> Column:
    """Minute-boundary difference (BigQuery TIME_DIFF(..., MINUTE))."""
    return minute_of_day(end) - minute_of_day(start)


def overtime_hours(clock_in, clock_out) -> Column:
    """Hours beyond 8 of a shift; +24h when the shift crosses midnight; null
    when a clock is missing."""
    ci, co = col(clock_in), col(clock_out)
    mins = F.when(co < ci, minute_diff(co, ci) + 24 * 60).otherwise(minute_diff(co, ci))
    return F.when(ci.isNotNull() & co.isNotNull(),
                  F.greatest(mins.cast("double") / 60.0 - 8.0, F.lit(0.0)))


def month_start(c) -> Column:
    return F.trunc(col(c), "month")


def period_to_date(c) -> Column:
    """'YYYY-MM' text -> first day of that month."""
    return F.to_date(col(c), "yyyy-MM")


def dround(c, digits: int) -> Column:
    """Round a double to ``digits`` decimals as ``round(x * 10^d) / 10^d``
    (half away from zero on the scaled binary value). Spark's ``round``
    rounds the shortest decimal text instead, which differs on exact
    decimal ties (0.4421875): published numbers use this one form so they
    are bit-identical wherever they are recomputed."""
    m = 10.0 ** digits
    return F.round(col(c).cast("double") * m) / m


def finish(df: DataFrame, scale: int = 6) -> DataFrame:
    """Published-column conventions: ratios rounded to ``scale`` decimals,
    integral columns widened to bigint (ids from row_number/rank, hours...)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(dround(F.col(f.name), scale).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` treating null = null (window-partition semantics)."""
    r = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__k_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__k_{k}" for k in keys])


def group_total(df: DataFrame, keys: list[str], value: str, alias: str, fn=F.sum) -> DataFrame:
    """Attach ``fn(value)`` over the group ``keys`` to every row (a window
    partition aggregate; nulls in ``keys`` form one group).

    Used on already-aggregated rows only (facts at day/outlet grain), where a
    partition holds one row per dimension member, so it costs one small
    exchange and never re-reads the input — a groupBy joined back would
    evaluate the whole upstream plan twice."""
    return df.withColumn(alias, fn(value).over(Window.partitionBy(*keys)))


def _lands_on(d: Column, n: int):
    # one-argument lambdas only: PySpark reads a second parameter as the index
    return lambda t: F.add_months(t, -n) == d


def _tagged(i: int):
    return lambda t: F.struct(t.alias("d"), F.lit(i).alias("tag"))


def shift_values(df: DataFrame, keys: list[str], date_col: str, values: list[str],
                 shifts: dict[str, int]) -> DataFrame:
    """Attach, for every row, ``values`` of the row exactly N months earlier
    (S4: month ends clamp, 31 Mar -> 29 Feb; gaps give null; null keys never
    match), for several N at once — e.g. {"mom_": 1, "yoy_": 12}.

    Same result as one self join per shift on (keys, add_months(date, -N)),
    but the input is evaluated ONCE and shuffled ONCE: every row is exploded
    into itself plus copies dated at the future days whose N-months-earlier
    day it is (one date, up to four for a month end), and the copies are
    grouped by (keys, date). A self join would evaluate the whole upstream
    plan once per join side. Requires one row per (keys, date) among rows
    with non-null keys — true for the aggregated facts it is used on; rows
    with a null key or date pass through with null shifted values."""
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys + [date_col]])
    d = F.col(date_col)
    entries = [F.array(F.struct(d.alias("d"), F.lit(0).alias("tag")))]
    for i, (_p, n) in enumerate(shifts.items(), start=1):
        first = F.add_months(d, n)
        cand = F.when(d == F.last_day(d), F.sequence(first, F.last_day(first))).otherwise(F.array(first))
        hits = F.filter(cand, _lands_on(d, n))
        entries.append(F.transform(hits, _tagged(i)))
    out_cols = [f"{p}{v}" for p in shifts for v in values]
    # rows with a null key only pass through, grouped by a hash of the whole row
    # (a row id would change when a lost task runs again) and counted, so that
    # equal rows stay as many; keyed rows also emit their shifted copies
    uid = F.when(keyed, F.lit(None).cast("long")).otherwise(F.xxhash64(*df.columns))
    all_entries = F.when(keyed, F.concat(*entries)).otherwise(entries[0])
    e = df.select(F.struct(*df.columns).alias("__row"), *keys, *values, uid.alias("__uid"),
                  F.explode(all_entries).alias("__e"))
    tag = F.col("__e.tag")
    shifted = [F.when(tag == i, F.col(v)).alias(f"{p}{v}")
               for i, p in enumerate(shifts, start=1) for v in values]
    e = e.select(*keys, "__uid", F.col("__e.d").alias("__d"), F.when(tag == 0, F.col("__row")).alias("__row"),
                 *shifted)
    g = e.groupBy(*keys, "__d", "__uid").agg(
        F.first("__row", ignorenulls=True).alias("__row"), F.count("__row").alias("__n"),
        *[F.first(c, ignorenulls=True).alias(c) for c in out_cols])
    copies = F.when(F.col("__uid").isNull(), 1).otherwise(F.col("__n")).cast("int")
    # keys and date are those of the group: a reader of no other column needs no rows shuffled
    at = {**{k: F.col(k) for k in keys}, date_col: F.col("__d").alias(date_col)}
    return (g.where(F.col("__n") > 0)
            .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies)))
            .select(*[at.get(c, F.col(f"__row.`{c}`")) for c in df.columns], *out_cols))


LOOKUP_SPREAD = 64


def lookup(df: DataFrame, dim: DataFrame, on: str, dim_name: str, dim_id: str) -> DataFrame:
    """Left-join a dimension by its natural name and attach its surrogate id.

    Dimensions are small by construction; the planner broadcasts them when the
    size estimate (or, with AQE, the materialised size) is under the broadcast
    threshold, and falls back to a shuffle join otherwise. A few names may be those
    of all rows, so each is met in ``LOOKUP_SPREAD`` places, by a hash of the row:
    a shuffle join by the name alone has as many tasks as names.
    """
    own, there = f"__ds_{dim_id}", f"__dt_{dim_id}"
    d = dim.select(F.col(dim_name).alias(f"__dn_{dim_id}"), F.col(dim_id),
                   F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SPREAD - 1))).alias(there))
    rows = df.withColumn(own, F.pmod(F.xxhash64(*df.columns), F.lit(LOOKUP_SPREAD)).cast("int"))
    return (rows.join(d, (rows[on] == d[f"__dn_{dim_id}"]) & (rows[own] == d[there]), "left")
            .drop(f"__dn_{dim_id}", own, there))


def left_join_skip_null_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` where rows with a null key cannot pile up in one task.

    Null keys never match, but hash partitioning would send all of them (e.g.
    every walk-in without a guest id) to the same reducer. Each null key is
    replaced by a value no right-side key can equal (a NUL-prefixed hash of the
    row, the same whenever the task runs), which spreads those rows evenly and
    still matches nothing: one pass over ``df``, no extra branch."""
    if not isinstance(df.schema[key].dataType, T.StringType):
        right_cols = [c for c in other.columns if c != key]
        matched = df.where(F.col(key).isNotNull()).join(other, key, "left")
        unmatched = df.where(F.col(key).isNull()).select(
            "*", *[F.lit(None).cast(other.schema[c].dataType).alias(c) for c in right_cols])
        return matched.unionByName(unmatched.select(*matched.columns))
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
    left = df.withColumn("__jk", F.coalesce(F.col(key), salt))
    right = other.withColumnRenamed(key, "__jk")
    return left.join(right, "__jk", "left").drop("__jk")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by name as a balanced tree: each DataFrame call re-analyses its
    whole plan, so a left-deep chain of n unions costs O(n^2) analysis while a
    balanced one costs O(n log n). The executed plan is the same flat Union."""
    parts = list(parts)
    if not parts:
        raise ValueError("nothing to union")
    while len(parts) > 1:
        nxt = [parts[i].unionByName(parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
        if len(parts) % 2:
            nxt.append(parts[-1])
        parts = nxt
    return parts[0]


def union_apart(parts) -> DataFrame:
    """Union by name of small results, each evaluated by itself into one table in the
    shared checkpoint folder. A part's shuffle files go when it is written, so the disk
    holds those of one part at a time; in one plan, those of all parts stay until its end."""
    import uuid

    from innspark.session import scratch_dir
    path = schema = None
    for df in parts:
        if schema is None:
            spark, schema = df.sparkSession, df.schema
            path = scratch_dir(spark, f"parts-{uuid.uuid4().hex}")
        write_part(df.select(*schema.names), path)
    if schema is None:
        raise ValueError("nothing to union")
    return spark.read.schema(schema).parquet(path)


def write_part(df: DataFrame, path: str) -> None:
    from innspark.session import shuffles_dropped
    with shuffles_dropped(df.sparkSession):
        df.write.mode("append").parquet(path)
