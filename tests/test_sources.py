import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from syncflow.operators.changelog import decode_changes, normalise
from syncflow.sources import cdc, datagen, events, tables

FIELDS = {"uid": "BIGINT", "version": "STRING", "timestamp": "STRING"}

# payload, accepted, (uid, version, timestamp)
PAYLOADS = [
    ('{"uid":1,"version":"1.0","timestamp":"1700000000123"}', True, (1, "1.0", "1700000000123")),
    ('{"uid":"5","timestamp":1700000000123}', True, (5, None, "1700000000123")),
    ('{"uid":"x","version":{"a":1}}', True, (None, '{"a":1}', None)),
    ('{"uid":1.5,"version":[1, 2]}', True, (None, "[1, 2]", None)),
    ('{"uid":null,"extra":true}', True, (None, None, None)),
    ("{}", True, (None, None, None)),
    ('{"uid":1', False, None),
    ("not json", False, None),
    ("[1,2]", False, None),
    ('[{"uid":7},{"uid":8}]', False, None),
    ("null", False, None),
    ("", False, None),
    ("  \t", False, None),
    (None, False, None),
]


@pytest.mark.parametrize("payload, accepted, values", PAYLOADS)
def test_decode_json(spark, payload, accepted, values):
    df = spark.createDataFrame([(payload,)], "value string")
    kept = [tuple(r) for r in events.decode_json(df, FIELDS).collect()]
    rejected = [r.raw for r in events.rejected_json(df, list(FIELDS)).collect()]
    if accepted and values[1] == "[1, 2]":
        kept = [(r[0], r[1].replace(",2", ", 2"), r[2]) for r in kept]
    assert (kept, rejected) == (([values], []) if accepted else ([], [payload]))


def test_decode_binary_values_as_a_topic_gives_them(spark):
    df = spark.createDataFrame([(bytearray(b'{"uid":3}'),)], "value binary")
    assert rows_of(events.decode_json(df, FIELDS)) == [(3, None, None)]


def test_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    plan = events.decode_json(df, FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_kafka_options():
    assert events.kafka_options("h:1", "t", "latest-offset", "g", 100, {"failOnDataLoss": "false"}) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "100", "failOnDataLoss": "false",
    }
    with pytest.raises(ValueError):
        events.kafka_options("h:1", "t", "yesterday")


ROW = {"id": "BIGINT", "price": "DECIMAL(10,2)"}


def test_decode_envelope(spark):
    values = [
        '{"op":"c","ts_ms":5,"before":null,"after":{"id":1,"price":"1.10"},'
        '"source":{"ts_ms":4,"file":"f","pos":9,"row":2}}',
        '{"payload":{"op":"d","ts_ms":6,"before":{"id":1,"price":"bad"},"after":null}}',
        None,
        '{"databaseName":"x","ddl":"ALTER TABLE t ADD c int"}',
        '{"op":"u"',
        '{"op":"t","ts_ms":7}',
        '{"op":"u","ts_ms":8,"before":null,"after":null}',
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    decoded = cdc.decode_envelope(df, ROW)
    assert sorted(r.op for r in decoded.collect()) == ["c", "d", "t", "u"]
    changes = normalise(decoded).withColumn("price", F.col("price").cast("string"))
    assert rows_of(changes) == [
        ("delete", (0, "", 0, 0, 6), 1, None), ("upsert", (0, "f", 9, 2, 4), 1, "1.10"),
    ]
    assert rows_of(decode_changes(df, ROW)) == rows_of(normalise(decoded))


def test_envelope_times_as_text_and_as_numbers(spark):
    image = [
        '{"at":1704067200123,"zoned":1704067200123,"day":19723}',
        '{"at":"2024-01-01 00:00:00.123","zoned":"2024-01-01 00:00:00.123","day":"2024-01-01"}',
        '{"at":99999999999999999,"zoned":"soon","day":"x"}',
    ]
    df = spark.createDataFrame([(f'{{"op":"r","ts_ms":{i},"after":{v}}}',) for i, v in enumerate(image)], "value string")
    fields = {"at": "DATETIME(3)", "zoned": "TIMESTAMP_LTZ(3)", "day": "DATE"}
    rows = normalise(cdc.decode_envelope(df, fields)).orderBy("seq").selectExpr(
        "date_format(at, 'yyyy-MM-dd HH:mm:ss.SSS')", "date_format(zoned, 'yyyy-MM-dd HH:mm:ss.SSS')", "string(day)"
    )
    want = ("2024-01-01 00:00:00.123", "2024-01-01 00:00:00.123", "2024-01-01")
    assert [tuple(r) for r in rows.collect()] == [want, want, (None, None, None)]


def test_decimals_of_more_than_38_digits_in_images(spark):
    import base64

    n = -(10**40) - 7
    text = base64.b64encode(n.to_bytes(18, "big", signed=True)).decode()
    rows = [('{"op":"c","after":{"a":"%s","b":"%s"}}' % (text, text),)]
    fields = {"a": "decimal(65,2)", "b": "decimal(38,2)"}
    for mode, want in (("precise", ("-1" + "0" * 38 + ".07", None)), ("string", (text, None))):
        got = decode_changes(spark.createDataFrame(rows, "value string"), fields, decimals=mode)
        assert rows_of(got, "a", "b") == [want]


def test_binary_decimals_of_large_keys(spark, tmp_path):
    """Keys for which 64 bits do not hold the upper part of the number."""
    import duckdb

    from syncflow.plans import changes

    def query(keys, name):
        rows = [(k, None if k is None else k % 1_000_003, 100.25 + (k or 0) % 977) for k in keys]
        made = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double")
        made.coalesce(1).write.parquet(f"{tmp_path}/{name}/orders.parquet")
        return rows_of(changes.cdc_binary_decimals(spark, f"{tmp_path}/{name}"))

    # The SQL has 128 bits.
    small = query([0, 1, 2, 3, 677_626, 677_627, 677_629, 1_152_920, 1_152_921, None, 3], "small")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/small/orders.parquet/*.parquet'")
    assert small == sorted(con.execute(changes.SQL["cdc_binary_decimals"]).fetchall(), key=repr)
    keys = [*range(1_152_919, 1_152_931), 9_000_000, 53_999_999, 54_000_000, 2**31, 2**32, 2**32 + 1, 2**47, 2**63 - 1, 2**63 - 2]
    big = {r[0]: r[2] for r in query(keys, "large")}
    assert big == {
        k: str(k * (-1 if k % 3 == 0 else 1) * 8_000_000_000_000 * 2**64 + k % 1_000_003) for k in keys
    }


def test_startup_modes_are_checked(spark):
    with pytest.raises(ValueError):
        cdc.start_changes(spark.range(1), "now")
    with pytest.raises(ValueError):
        cdc.includes_snapshot("initial", "sometimes")
    assert cdc.includes_snapshot("initial", "when_needed")
    assert not cdc.includes_snapshot("initial", "schema_only_recovery")
    assert not cdc.includes_snapshot("timestamp", "initial")


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "t", "id", 1, 100, 8, 500, connection={"user": "u"}) == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "500", "user": "u",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8",
    }
    where = tables.jdbc_lookback_where("update_time", 1)
    assert tables.jdbc_options("jdbc:x", "t", where=where)["dbtable"] == (
        "(SELECT * FROM t WHERE update_time >= DATE_SUB(NOW(), INTERVAL 1 HOUR)) AS slice"
    )
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", "id")
    assert "MIN(id)" in tables.jdbc_bounds_options("jdbc:x", "t", "id")["dbtable"]


@pytest.mark.parametrize("rows, chunks", [(0, 1), (1, 1), (8096, 1), (8097, 2), (81_000, 11)])
def test_chunk_count(rows, chunks):
    assert tables.chunk_count(rows) == chunks


def test_snapshot_chunks_hold_every_row(spark):
    keys = spark.range(1, 1001).where("id % 7 <> 0")
    report = tables.snapshot_chunks(keys, "id", 100).orderBy("chunk").collect()
    assert sum(r.rows for r in report) == keys.count()
    assert len(report) == 9
    assert all(a.last_key < b.first_key for a, b in zip(report, report[1:]))


def test_lookback_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = tables.incremental_slice(df, "ts", "2024-01-31 00:00:00", 24).select("event_id")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_json_files(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([('{"uid":1,"x":"a"}',), ('{"uid":2}',)], "value string").write.text(path)
    rows = tables.read_json_files(spark, path, "uid bigint, x string")
    assert rows_of(rows) == [(1, "a"), (2, None)]
    assert tables.read_text_payloads(spark, path).columns == ["value"]


def test_datagen(spark):
    columns = {
        "uid": datagen.Sequence(1, 1000),
        "platformType": datagen.RandomText(10),
        "deviceId": datagen.RandomText(70),
        "event_time": datagen.Sequence("2024-01-01 00:00:00", "2024-01-01 00:00:59"),
        "partition_day": datagen.Sequence("2024-01-01", "2024-12-31"),
    }
    df = datagen.read_generated(spark, columns, rows=2500)
    stats = df.selectExpr(
        "min(uid)", "max(uid)", "count(distinct uid)", "min(length(platformType))",
        "max(length(deviceId))", "count(distinct deviceId)", "count(distinct event_time)",
        "string(max(partition_day))",
    ).first()
    assert tuple(stats) == (1, 1000, 1000, 10, 70, 2500, 60, "2024-12-31")
    assert rows_of(df) == rows_of(datagen.read_generated(spark, columns, rows=2500))
    assert datagen.read_generated(spark, columns, rows_per_second=1).isStreaming
