"""Scalar and table functions (U1-U3, J6 casts), all JVM-side.

Everything here is a Spark SQL expression, so it stays inside whole-stage
codegen; nothing is evaluated row by row in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The JVM string hash is h = 31 * h + u over UTF-16 code units u,
# wrapped to a signed 32-bit int; an empty string hashes to 0.
JVM_HASH_SQL = """aggregate(split({s}, ''), 0L, (h, c) -> CASE
    WHEN c = '' THEN h
    WHEN ascii(c) < 65536 THEN (h * 31 + ascii(c)) & 4294967295L
    ELSE ((h * 31 + 55296 + ((ascii(c) - 65536) div 1024)) * 31 + 56320 + (ascii(c) - 65536) % 1024) & 4294967295L END,
  h -> CAST(CASE WHEN h >= 2147483648L THEN h - 4294967296L ELSE h END AS INT))"""


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_hash(col: str | Column) -> Column:
    """``String.hashCode`` of a string column (not Spark's Murmur3 ``hash``).

    The text is split into characters once and folded; a character beyond the
    basic plane is two units.  Time is linear in the length."""
    mask = 4294967295

    def step(h: Column, c: Column) -> Column:
        u = F.ascii(c).cast("bigint")
        high = (u - 65536) / 1024
        pair = (h * 31 + 55296 + F.floor(high)) * 31 + 56320 + (u - 65536) % 1024
        return (F.when(c == "", h).when(u < 65536, (h * 31 + u).bitwiseAND(F.lit(mask)))
                .otherwise(pair.bitwiseAND(F.lit(mask))))
    return F.aggregate(F.split(_c(col), ""), F.lit(0).cast("bigint"), step,
                       lambda h: F.when(h >= 2147483648, h - 4294967296).otherwise(h).cast("int"))


def wrap_int(col: str | Column) -> Column:
    """``Long.toInt`` — keep the low 32 bits, signed (ANSI ``cast`` raises
    on overflow instead)."""
    c = _c(col)
    return ((c.bitwiseAND(F.lit(4294967295)).bitwiseXOR(F.lit(2147483648)))
            - F.lit(2147483648)).cast("int")


def digits(col: str | Column) -> Column:
    """The first run of digits of a string, with its sign (empty without one)."""
    return F.regexp_extract(_c(col), r"(-?\d+)", 1)


def to_int(col: str | Column, strict: bool = True) -> Column:
    """``String.toInt`` of a whole string.  ``strict`` raises on a string that is
    no number or does not fit (ANSI cast); otherwise such values give NULL."""
    whole = F.when(_c(col).rlike(r"^[+-]?\d+$"), _c(col)).otherwise(F.concat(F.lit("not a number: "), _c(col)))
    return whole.cast("int") if strict else whole.try_cast("int")


def digits_to_int(col: str | Column, strict: bool = True) -> Column:
    """The number inside a string, e.g. of a name that ends in one."""
    return to_int(digits(col), strict)


def leading_char(col: str | Column) -> list[Column]:
    """The row of the table function: a text's first character and how many
    characters that is (0 for the empty text)."""
    first = F.left(_c(col), F.lit(1))
    return [first.alias("first_char"), F.char_length(first).alias("n_chars")]


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``jvm_hash(text)`` and the table function ``leading_char(text)``
    for ``spark.sql``.  Both are SQL functions, inlined by the analyzer."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION jvm_hash(text STRING) RETURNS INT RETURN "
              + JVM_HASH_SQL.replace("{s}", "text"))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION leading_char(text STRING) "
              "RETURNS TABLE (first_char STRING, n_chars INT, read_at TIMESTAMP) "
              "RETURN SELECT left(text, 1), char_length(left(text, 1)), current_timestamp()")


def message(fmt: str, *cols: str | Column) -> Column:
    """A printable message column from typed columns (``printf`` format),
    for console sinks; keep the typed columns for everything else."""
    return F.format_string(fmt, *[_c(c) for c in cols])


def from_epoch_millis(col: str | Column) -> Column:
    """Epoch milliseconds (the reference's time fields) to a timestamp."""
    return F.timestamp_millis(_c(col))
