"""Source column types to Spark types, and tolerant casting of all-text tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.times import parse_timestamp, utc_wall

_TYPE = re.compile(r"\s*([a-z_]+(?:\s+precision)?)\s*(?:\(([^)]*)\))?\s*(.*?)\s*", re.IGNORECASE)

# Base type name -> Spark type. Widths, unsigned and precision are
# handled in parse_type; any name that is not listed is kept as text.
_PLAIN = {
    "tinyint": T.ByteType(), "smallint": T.ShortType(), "mediumint": T.IntegerType(),
    "int": T.IntegerType(), "integer": T.IntegerType(), "bigint": T.LongType(),
    "float": T.DoubleType(), "double": T.DoubleType(), "double precision": T.DoubleType(),
    "real": T.DoubleType(),
    "date": T.DateType(), "time": T.StringType(), "year": T.IntegerType(),
    "datetime": T.TimestampNTZType(), "timestamp": T.TimestampNTZType(),
    "timestamp_ltz": T.TimestampType(),
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "string": T.StringType(),
}
_UNSIGNED = {
    "tinyint": T.ShortType(), "smallint": T.IntegerType(), "mediumint": T.IntegerType(),
    "int": T.LongType(), "integer": T.LongType(),
}

# JSON value kinds. Objects and arrays stay raw JSON text.
JSON_KINDS = {
    "number": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "object": T.StringType(), "array": T.StringType(),
}

_DECIMALS = ("decimal", "numeric", "dec")


def _type_parts(text: str) -> tuple[str, list[str], bool]:
    """Base name, arguments, and whether it is unsigned."""
    found = _TYPE.fullmatch(text)
    if not found:
        raise ValueError(f"not a column type: {text!r}")
    base = re.sub(r"\s+", " ", found.group(1).lower())
    args = [a.strip() for a in (found.group(2) or "").split(",") if a.strip()]
    return base, args, "unsigned" in found.group(3).lower()


def _decimal_size(args: list[str]) -> tuple[int, int]:
    return int(args[0]) if args else 10, int(args[1]) if len(args) > 1 else 0


def parse_type(
    text: str, decimal_mode: str = "precise", unsigned_bigint_mode: str = "long"
) -> T.DataType:
    """Map a database or job-declaration type such as ``decimal(12,4)`` or ``BIGINT UNSIGNED``.

    ``decimal_mode`` is ``precise``, ``string`` or ``double``; ``unsigned_bigint_mode`` is
    ``long`` (values above 2^63-1 become NULL) or ``precise`` (``decimal(20,0)``).
    """
    base, args, unsigned = _type_parts(text)
    if base == "tinyint" and args == ["1"] or base == "bit" and args in ([], ["1"]):
        return T.BooleanType()
    if base in _DECIMALS:
        if decimal_mode == "string":
            return T.StringType()
        if decimal_mode == "double":
            return T.DoubleType()
        precision, scale = _decimal_size(args)
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    if unsigned and base == "bigint":
        return T.LongType() if unsigned_bigint_mode == "long" else T.DecimalType(20, 0)
    if unsigned and base in _UNSIGNED:
        return _UNSIGNED[base]
    return _PLAIN.get(base, T.StringType())


def resolve_type(spec) -> T.DataType:
    """A Spark ``DataType``, a JSON kind, or a type text."""
    if isinstance(spec, T.DataType):
        return spec
    return JSON_KINDS.get(spec) or parse_type(spec)


def wide_decimal(spec) -> tuple[int, int] | None:
    """Declared digits and scale of a decimal that is kept as text, as Spark's hold 38 digits."""
    if not isinstance(spec, str) or spec in JSON_KINDS:
        return None
    base, args, _ = _type_parts(spec)
    if base not in _DECIMALS:
        return None
    precision, scale = _decimal_size(args)
    return (precision, scale) if precision > 38 else None


def time_precision(spec) -> int:
    """Declared digits of a second, 3 where nothing is declared."""
    found = re.search(r"\((\d)\)", spec) if isinstance(spec, str) else None
    return int(found.group(1)) if found else 3


def cast_text(col: Column, to, timestamp_standard: str = "SQL") -> Column:
    """Text to ``to`` with NULL for whatever does not convert."""
    precision, to = time_precision(to), resolve_type(to)
    if isinstance(to, T.StringType):
        return col
    if isinstance(to, (T.StructType, T.ArrayType)):
        return F.from_json(col, to)
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        # Text with a zone becomes UTC wall time where the column has none.
        instant = parse_timestamp(col, timestamp_standard)
        # Unless more is declared, times have millisecond precision, hence are truncated.
        instant = instant if precision > 3 else F.timestamp_millis(F.unix_millis(instant))
        return utc_wall(instant) if isinstance(to, T.TimestampNTZType) else instant
    # Flags arrive as true/false or 1/0; both convert.
    return col.try_cast(to)


def _named(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` mentions it."""
    return F.transform(F.array(value), then)[0]


def _binary_text(col: Column, scale: int, words: int, magnitude) -> Column:
    """Base64 of a big-endian two's complement number to its digits; NULL for more than ``words`` of 32 bits.

    ``magnitude`` makes digits from hexadecimal ones, and adds a number to them.
    """
    width = 8 * words

    def scaled(digits: Column) -> Column:
        if not scale:
            return digits
        long = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), F.lit("0"))
        return _named(long, lambda x: F.concat(
            F.substring(x, F.lit(1), F.length(x) - scale), F.lit("."), F.right(x, F.lit(scale))
        ))

    def positive(core: Column) -> Column:
        filled = F.lpad(core, width, "0")
        return F.when(F.length(core) <= width, _named(filled, lambda x: scaled(magnitude(x, F.lit(0)))))

    def negative(core: Column) -> Column:
        filled = F.translate(F.lpad(core, width, "F"), "0123456789ABCDEF", "FEDCBA9876543210")
        return F.when(F.length(core) <= width, F.concat(F.lit("-"), _named(filled, lambda x: scaled(magnitude(x, F.lit(1))))))

    def short(number: Column) -> Column:
        minus = number.startswith("-")
        return F.when(minus, F.concat(F.lit("-"), scaled(F.substring(number, 2, 19)))).otherwise(scaled(number))

    def signed(digits: Column) -> Column:
        # 64 bits are converted at once. Leading sign bytes say nothing; what is left has to fit into the words.
        below = digits.rlike("^[89A-F]")
        filled = F.lpad(digits, F.lit(16), F.when(below, "F").otherwise("0"))
        return (
            F.when(F.length(digits).between(1, 16), _named(F.conv(filled, 16, -10), short))
            .when(below, _named(F.regexp_replace(digits, "^(FF)+(?=[89A-F])", ""), negative))
            .when(digits != "", _named(F.regexp_replace(digits, "^(00)+(?=[0-7])", ""), positive))
        )

    return _named(F.hex(F.try_to_binary(col, F.lit("base64"))), signed)


def binary_decimal(col: Column, to: T.DecimalType) -> Column:
    """Base64 of a big-endian two's complement number, unscaled, to a decimal; NULL for anything else.

    Any number of bytes, as long as the number has no more digits than ``to``. Built-ins alone: the
    magnitude is put together from two halves of 64 bits, which a decimal of 38 digits holds.
    """
    whole = "decimal(38,0)"

    def magnitude(hexes: Column, more: Column) -> Column:
        upper, lower = [F.conv(F.substring(hexes, at, 16), 16, 10).cast("decimal(20,0)").cast(whole) for at in (1, 17)]
        total = F.try_multiply(upper, F.lit(str(2**64)).cast(whole)).cast(whole)
        return F.try_add(F.try_add(total, lower).cast(whole), more.cast(whole)).cast(whole).cast("string")

    return _binary_text(col, to.scale, 4, magnitude).try_cast(to)


def binary_decimal_text(col: Column, precision: int, scale: int) -> Column:
    """The same as text, for decimals of any number of digits; NULL for a number with more than ``precision``.

    Built-ins alone: each power of 2^32 is known in groups of decimal digits. Groups are summed over the
    words, in 64 bits, and what exceeds a group is carried on.
    """
    words = ((10**precision).bit_length() + 32) // 32
    group = len(str(2**31 // (words + 1))) - 1
    groups = -(-len(str(2 ** (32 * words))) // group)
    weights = [
        [2 ** (32 * (words - 1 - i)) // 10 ** (group * j) % 10**group for i in range(words)] for j in range(groups)
    ]

    def carried(acc: Column, x: Column) -> Column:
        total = acc.getField("carry") + x
        digits = F.lpad((total % 10**group).cast("string"), group, "0")
        return F.struct(
            F.call_function("div", total, F.lit(10**group)).alias("carry"),
            F.concat(digits, acc.getField("digits")).alias("digits"),
        )

    def magnitude(hexes: Column, more: Column) -> Column:
        numbers = F.array(*[F.conv(F.substring(hexes, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(words)])
        zero = F.lit(0).cast("bigint")
        sums = _named(numbers, lambda ns: F.array(*[
            reduce(lambda a, b: a + b, [ns[i] * F.lit(w) for i, w in enumerate(ws) if w], zero) for ws in weights
        ]))
        start = F.struct(more.cast("bigint").alias("carry"), F.lit("").alias("digits"))
        whole = F.aggregate(sums, start, carried, lambda acc: F.regexp_replace(acc.getField("digits"), "^0+(?=.)", ""))
        return _named(whole, lambda x: F.when(F.length(x) <= precision, x))

    return _binary_text(col, scale, words, magnitude)


def apply_schema(df: DataFrame, columns: dict, timestamp_standard: str = "SQL") -> DataFrame:
    """Cast a table of text columns to the declared types, in the declared order."""
    return df.select(
        *[cast_text(F.col(n), t, timestamp_standard).alias(n) for n, t in columns.items()]
    )
