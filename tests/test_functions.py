import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows_of
from syncflow.functions import times
from syncflow.functions.classify import SINGLE_MATCH_TIERS, classify, tier
from syncflow.functions.types import apply_schema, binary_decimal, binary_decimal_text, parse_type, wide_decimal


@pytest.mark.parametrize("text, kind", [
    ("bigint(20)", T.LongType()),
    ("bigint unsigned", T.LongType()),
    ("int(11) unsigned", T.LongType()),
    ("INT", T.IntegerType()),
    ("tinyint(1)", T.BooleanType()),
    ("tinyint(4)", T.ByteType()),
    ("tinyint unsigned", T.ShortType()),
    ("smallint", T.ShortType()),
    ("mediumint unsigned", T.IntegerType()),
    ("point", T.StringType()),
    ("varchar(255)", T.StringType()),
    ("longtext", T.StringType()),
    ("enum('int','date')", T.StringType()),
    ("datetime(3)", T.TimestampNTZType()),
    ("TIMESTAMP(3)", T.TimestampNTZType()),
    ("TIMESTAMP_LTZ(3)", T.TimestampType()),
    ("date", T.DateType()),
    ("time", T.StringType()),
    ("decimal(12,4)", T.DecimalType(12, 4)),
    ("DECIMAL(10, 2)", T.DecimalType(10, 2)),
    ("numeric", T.DecimalType(10, 0)),
    ("decimal(65,30)", T.StringType()),
    ("float", T.DoubleType()),
    ("double precision", T.DoubleType()),
    ("BOOLEAN", T.BooleanType()),
    ("json", T.StringType()),
])
def test_parse_type(text, kind):
    assert parse_type(text) == kind


def test_parse_type_modes():
    assert parse_type("decimal(10,2)", decimal_mode="string") == T.StringType()
    assert parse_type("decimal(10,2)", decimal_mode="double") == T.DoubleType()
    assert parse_type("bigint unsigned", unsigned_bigint_mode="precise") == T.DecimalType(20, 0)
    with pytest.raises(ValueError):
        parse_type("(10)")


def test_apply_schema_gives_null_for_what_does_not_convert(spark):
    df = spark.createDataFrame(
        [("7", "1", "2024-01-31 10:20:30.123456", "1.239"), ("x", "maybe", "31.01.2024", "one")],
        "a string, b string, c string, d string",
    )
    typed = apply_schema(df, {
        "a": "int", "b": "tinyint(1)", "c": "datetime(3)", "d": "decimal(10,2)",
    })
    assert rows_of(typed.withColumn("d", F.col("d").cast("string"))) == [
        (7, True, dt.datetime(2024, 1, 31, 10, 20, 30, 123000), "1.24"), (None, None, None, None),
    ]


@pytest.mark.parametrize("text, want", [
    ("1700000000123", "2023-11-14 22:13:20.123"),
    ("1700000000100", "2023-11-14 22:13:20.100"),
    ("0", "1970-01-01 00:00:00.000"),
    ("-1", "1969-12-31 23:59:59.999"),
    ("253402300799999", "9999-12-31 23:59:59.999"),
    ("253402300800000", None),
    ("99999999999999999", None),
    ("999999999999999999999999", None),
    ("12.5", None),
    ("abc", None),
    ("", None),
    (None, None),
])
def test_epoch_millis_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.timestamp_text(times.millis_to_timestamp("t"))).first()[0] == want
    day = df.select(times.day_text(times.event_day_from_millis("t", "2000-01-01"))).first()[0]
    assert day == (want[:10] if want else "2000-01-01")


def test_fallback_day_is_today_by_default(spark):
    row = spark.range(1).select(
        times.event_day(F.lit(None).cast("timestamp")).alias("d"), F.current_date().alias("t")
    ).first()
    assert row.d == row.t


def test_epoch_seconds_of_both_timestamp_types(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:01.999999' n, timestamp'2024-01-01 00:00:01.999999' z"
    )
    n = df.select(times.epoch_seconds(df, "n")).first()[0]
    z = df.select(times.epoch_seconds(df, "z")).first()[0]
    assert n == z == 1704067201


def test_timestamp_standards(spark):
    df = spark.createDataFrame([("2024-01-01T01:02:03.5",), ("2024-01-01 01:02:03",), ("no",)], "t string")
    iso = df.select(times.timestamp_text(times.parse_timestamp("t", "ISO-8601"))).collect()
    sql = df.select(times.timestamp_text(times.parse_timestamp("t", "SQL"))).collect()
    assert [r[0] for r in iso] == ["2024-01-01 01:02:03.500", None, None]
    assert [r[0] for r in sql] == [None, "2024-01-01 01:02:03.000", None]


def test_source_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 07:00:00' t")
    assert df.select(times.to_utc("t", "Asia/Shanghai")).first()[0] == dt.datetime(2023, 12, 31, 23)


@pytest.mark.parametrize("text, want", [
    ("5s", "5 seconds"), ("10 SECONDS", "10 seconds"), ("1 min", "1 minutes"), ("24h", "24 hours"),
])
def test_interval_text(text, want):
    assert times.interval_text(text) == want


def test_interval_text_refuses_nonsense():
    with pytest.raises(ValueError):
        times.interval_text("soon")


def test_classify_takes_the_first_rule(spark):
    names = ["Kafka2Ods, doris", "my CDC to doris", "MySQL", "DORIS load", "other", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(classify("n")).collect()]
    assert got == ["kafka", "mysql_cdc", "mysql_cdc", "doris", "unknown", "unknown"]


def test_tier_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 0.8, 0.79, 0.6, 0.3, 0.29)], "s double")
    got = [r[0] for r in df.select(tier(F.col("s"), SINGLE_MATCH_TIERS, "poor")).collect()]
    assert got == ["excellent", "excellent", "good", "good", "fair", "poor"]


def test_binary_decimals(spark):
    import base64
    import random
    from decimal import Decimal

    rng = random.Random(4)
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 256, 10**38 - 1, 1 - 10**38, 2**63, -(2**63), 2**64, 99999]
    numbers += [rng.randrange(-(10**k), 10**k) for k in range(1, 38) for _ in range(3)]
    rows = []
    for n in numbers:
        size = max(1, (n.bit_length() + 8) // 8)
        rows.append((base64.b64encode(n.to_bytes(size, "big", signed=True)).decode(), n))
        rows.append((base64.b64encode(n.to_bytes(size + 5, "big", signed=True)).decode(), n))  # sign bytes in front
    df = spark.createDataFrame([(t, str(n)) for t, n in rows], "t string, n string")
    for kind in (T.DecimalType(38, 0), T.DecimalType(38, 2), T.DecimalType(12, 5), T.DecimalType(38, 38)):
        def want(n, kind=kind):
            value = Decimal(n).scaleb(-kind.scale) if abs(n) < 10**38 else None
            return value if value is not None and abs(n) < 10**kind.precision else None

        got = df.select("n", binary_decimal(F.col("t"), kind).alias("d")).collect()
        import decimal
        with decimal.localcontext() as c:
            c.prec = 80
            assert [r.d for r in got] == [want(int(r.n)) for r in got]
    bad = spark.createDataFrame([("",), (None,), ("not base64!",), ("AA=A",)], "t string")
    assert {r[0] for r in bad.select(binary_decimal(F.col("t"), T.DecimalType(10, 2))).collect()} == {None}


@pytest.mark.parametrize("precision, scale", [(39, 0), (65, 0), (65, 30), (65, 65), (130, 2)])
def test_binary_decimals_beyond_38_digits(spark, precision, scale):
    import base64
    import random
    from decimal import Decimal

    rng = random.Random(5)
    numbers = [0, 1, -1, -128, 2**63 - 1, 2**63, -(2**63), -(2**63) - 1, 2**64, 10**38, -(10**38), 2**127, -(2**127)]
    numbers += [10**precision - 1, 1 - 10**precision, 10**precision, -(10**precision), 2 ** (8 * precision)]
    numbers += [rng.randrange(-(10**k), 10**k) for k in range(1, precision + 3) for _ in range(2)]
    rows = []
    for n in numbers:
        size = max(1, (n.bit_length() + 8) // 8)
        rows += [(base64.b64encode(n.to_bytes(size + more, "big", signed=True)).decode(), str(n)) for more in (0, 5)]

    def want(n):
        if abs(n) >= 10**precision:
            return None
        digits = str(abs(n)).rjust(scale + 1, "0")
        whole = digits[:-scale] + "." + digits[-scale:] if scale else digits
        return "-" + whole if n < 0 else whole

    df = spark.createDataFrame(rows, "t string, n string")
    got = df.select("n", binary_decimal_text(F.col("t"), precision, scale).alias("d")).collect()
    assert [r.d for r in got] == [want(int(r.n)) for r in got]
    assert all(Decimal(r.d).scaleb(scale) == int(r.n) for r in got if r.d and len(r.d) < 28)
    bad = spark.createDataFrame([("",), (None,), ("not base64!",), ("AA=A",)], "t string")
    assert {r[0] for r in bad.select(binary_decimal_text(F.col("t"), precision, scale)).collect()} == {None}


def test_which_decimals_are_kept_as_text():
    assert wide_decimal("decimal(65,30)") == (65, 30) and wide_decimal("NUMERIC(39) unsigned") == (39, 0)
    for spec in ("decimal(38,0)", "decimal", "bigint", "varchar(255)", "string", "number", T.StringType(), T.DecimalType(38, 2)):
        assert wide_decimal(spec) is None
