"""Column expressions that reproduce the register's cleaning rules under ANSI mode.

All of these are built-in Catalyst expressions (whole-stage codegen, no Python).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "strip_text", "to_number", "to_ts", "normalise_serial", "strip_names", "drop_unnamed",
    "drop_all_null_rows", "drop_missing", "clean_records", "category_text", "shorten_label",
    "safe_key", "year_or_default", "valid_transactions", "with_revenue", "fill_constants",
    "rename_source_columns", "zero_if_null", "with_row_index", "ensure_record_id",
]

# Fixed value: the characters Python's str.strip() removes (str.isspace), U+3000 included.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")
# A plain decimal number, optional exponent ("1d", "1,0", "abc" do not match).
_NUMBER_RE = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
# Accepted date layouts, most specific first.
DATE_FORMATS = ("y-M-d H:m:s", "y-M-d H:m", "y-M-d'T'H:m:s", "y-M-d",
                "y/M/d H:m:s", "y/M/d H:m", "y/M/d", "yyyyMMdd")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """Trim like Python's str.strip(): spaces, tabs, newlines and U+3000 (character-set trim,
    no regex)."""
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def to_number(c) -> Column:
    """Text -> double; anything that is not a plain number (incl. 'nan', '1d', '') -> NULL."""
    return _parse_number(strip_text(_c(c).cast("string")))


def _parse_number(s: Column) -> Column:
    # the pattern admits no 'nan' / 'inf' text, so the guarded cast never yields NaN;
    # the value expression appears once (a NaN check around it would evaluate it twice)
    return F.when(s.rlike(_NUMBER_RE), s.try_cast("double"))


def to_ts(c, formats=None) -> Column:
    """Text -> wall-clock timestamp (TIMESTAMP_NTZ, like the register's naive datetimes),
    bad -> NULL.

    Default: '/' and 'T' are unified to '-' and ' ' by text replacement and the
    layout (seconds with or without a fraction, a UTC mark 'Z' dropped) is picked by the number of ':' (one parse attempt per row, no regex, no
    exception-driven fallbacks); 8 digits without separators parse as 'yyyyMMdd'.
    ``formats`` = explicit list, first match wins.
    """
    s = strip_text(_c(c).cast("string"))
    if formats is not None:
        return F.coalesce(*[_wall_clock(s, f) for f in formats])
    return _parse_unified(_drop_utc_mark(_unify_separators(s)))


def _unify_separators(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit("/"), F.lit("-")), F.lit("T"), F.lit(" "))


def _drop_utc_mark(u: Column) -> Column:
    return F.when(u.endswith("Z") & u.contains(":"), F.substring(u, F.lit(1), F.length(u) - 1)).otherwise(u)


def _parse_unified(u: Column) -> Column:
    colons = F.length(u) - F.length(F.replace(u, F.lit(":"), F.lit("")))
    return (F.when(colons == 2, _wall_clock(u, "y-M-d H:m:s[.SSSSSS]"))
             .when(colons == 1, _wall_clock(u, "y-M-d H:m"))
             .when(u.contains("-"), _wall_clock(u, "y-M-d"))
             .when(F.length(u) == 8, _wall_clock(u, "yyyyMMdd")))


def _wall_clock(s: Column, fmt: str) -> Column:
    """Zone-free (TIMESTAMP_NTZ) parse, NULL when the text does not fit ``fmt``. Both parses
    use the same zone-less formatter, so the guard accepts exactly the strings the NTZ parse
    accepts; a session-zone parse alone would move wall-clock times that fall into a DST gap."""
    return F.when(F.try_to_timestamp(s, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(s, F.lit(fmt)))


def normalise_serial(c) -> Column:
    """Serial numbers: trimmed; blank, 'None' and 'nan' mean missing (NULL)."""
    return _known_serial(strip_text(_c(c)))


def _known_serial(s: Column) -> Column:
    return F.when((s == "") | s.isin("None", "nan"), F.lit(None).cast("string")).otherwise(s)


def zero_if_null(c) -> Column:
    """pandas' sum of an all-missing column is 0, Spark's is NULL."""
    return F.coalesce(_c(c), F.lit(0.0))


def strip_names(df: DataFrame) -> DataFrame:
    """Trim header text."""
    return df.toDF(*[c.strip() for c in df.columns])


def rename_source_columns(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Source header names -> our names (only those present)."""
    from agrolens.schema import SOURCE_TO_COLUMN
    mapping = mapping or SOURCE_TO_COLUMN
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_unnamed(df: DataFrame) -> DataFrame:
    """C4: drop spreadsheet filler columns ('Unnamed: 17') and Spark's '_c17'."""
    pat = re.compile(r"^(Unnamed|_c\d+$)")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not pat.match(c)])


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every column is NULL."""
    return df.na.drop(how="all")


def drop_missing(df: DataFrame, cols) -> DataFrame:
    """Drop rows missing any of ``cols``."""
    return df.na.drop(how="any", subset=list(cols))


def clean_records(raw: DataFrame, keep=(), number_rows: bool = False) -> DataFrame:
    """S3 -> F2: one typed projection over an all-text record table.

    ``keep`` names extra columns passed through unchanged. Without a sequence column
    record_id is the register's value for a missing number (0); ``number_rows=True`` numbers
    the rows in input order instead (C13, writes the input once)."""
    from agrolens.schema import NUMERIC_COLUMNS, RECORD_COLUMNS
    df = drop_unnamed(rename_source_columns(strip_names(raw)))
    df = drop_all_null_rows(df)
    if "record_id" not in df.columns and number_rows:
        df = with_row_index(df, "record_id")
    for c in RECORD_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    # One projection a step, each naming its input once or by column: a single projection repeats the trimmed
    # text wherever it is used, and its generated method then exceeds the 8,000 bytes that the JVM compiles.
    numbers = [*NUMERIC_COLUMNS, "record_id"]
    trimmed = [*numbers, "purchase_date", "serial_no", "buyer"]
    kept = [F.col(k).alias(f"_keep{i}") for i, k in enumerate(keep)]
    df = df.select(*kept, *[(strip_text(F.col(c).cast("string")) if c in trimmed else F.col(c).cast("string")).alias(c)
                            for c in RECORD_COLUMNS])
    for step in (_unify_separators, _drop_utc_mark):
        df = df.withColumn("purchase_date", step(F.col("purchase_date")))
    exprs = []
    for c in RECORD_COLUMNS:
        e = F.col(c)
        if c in NUMERIC_COLUMNS:
            e = _parse_number(e)
        elif c == "purchase_date":
            e = _parse_unified(e)
        elif c == "record_id":
            e = F.coalesce(_parse_number(e).cast("bigint"), F.lit(0).cast("bigint"))
        elif c == "serial_no":
            e = _known_serial(e)
        exprs.append(e.alias(c))
    return df.select(*[F.col(f"_keep{i}").alias(k) for i, k in enumerate(keep)], *exprs)


def category_text(c, missing: str = "NA") -> Column:
    """Categorical as text, missing -> 'NA'."""
    return F.coalesce(_c(c).cast("string"), F.lit(missing))


def shorten_label(c, n: int = 25) -> Column:
    """Cut long labels to n characters + '...'."""
    x = _c(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def safe_key(c) -> Column:
    """C22: '/' and ' ' -> '_' (file / partition key)."""
    return F.translate(_c(c).cast("string"), "/ ", "__")


def year_or_default(c, default: int = 2024) -> Column:
    """Purchase year, default when the date is missing."""
    return F.coalesce(F.year(_c(c)), F.lit(default)).cast("int")


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULLs with constants per column."""
    return df.na.fill(values)


def valid_transactions(df: DataFrame, price="unit_price", qty="quantity",
                       min_price: float = 100.0, min_qty: float = 1.0) -> DataFrame:
    """C10 (+C7 fill 0 first): keep price > min_price and quantity >= min_qty."""
    return (df.withColumn(price, zero_if_null(price)).withColumn(qty, zero_if_null(qty))
              .filter((F.col(price) > min_price) & (F.col(qty) >= min_qty)))


def with_revenue(df: DataFrame, price="unit_price", qty="quantity", out="revenue") -> DataFrame:
    """C11: revenue = price * quantity."""
    return df.withColumn(out, F.col(price) * F.col(qty))


def with_row_index(df: DataFrame, out: str = "record_id", start: int = 1) -> DataFrame:
    """Consecutive row numbers in partition order without a global window.

    The rows are written once, with the id that holds partition and position, to the shared
    checkpoint folder. Counts and rows then come from the same written ids, whatever
    partitions another evaluation of the input would have had (AQE, retries); per-partition
    counts (one small row per partition) give the offsets.
    """
    import uuid

    from pyspark.sql import Window

    from agrolens.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, f"row-index-{uuid.uuid4().hex[:12]}")
    df.withColumn("_mid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    d = spark.read.parquet(path).withColumn("_pid", F.shiftright("_mid", 33))
    counts = d.groupBy(F.col("_pid").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    at = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (d.join(F.broadcast(offsets), F.col("_pid") == F.col("_p"))  # one row a partition
             .withColumn(out, (F.col("_off") + at + start).cast("bigint"))
             .select(*df.columns, out))


def ensure_record_id(df: DataFrame, col: str = "record_id") -> DataFrame:
    """Keep the source sequence number (coerced, NULL -> 0) or number the rows."""
    if col in df.columns:
        return df.withColumn(col, F.coalesce(to_number(F.col(col)).cast("bigint"), F.lit(0).cast("bigint")))
    return with_row_index(df, col)
