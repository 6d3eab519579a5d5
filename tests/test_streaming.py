import json

import pytest
from helpers import rows, values
from pyspark.sql import functions as F

from freightloom.schema import all_text
from freightloom.sources import decode_messages, read_json_records
from freightloom.streaming import (
    clean_and_stamp,
    dedupe_stream,
    kafka_source_options,
    land,
    land_counted,
    land_observed,
    landed_batches,
    landed_file_metrics,
    observed_batches,
    publish,
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def deliver(folder, name, records):
    (folder / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def lines(spark, folder, schema, per_trigger=None):
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.json(str(folder / "in"))


def drain(stream, folder, sink="out", checkpoint="checkpoint", **options):
    query = land(stream, str(folder / sink), str(folder / checkpoint), **options)
    query.awaitTermination()
    return query


def test_restart_adds_only_what_is_new(spark, folder):
    deliver(folder, "1.json", [{"id": 1}, {"id": 2}])
    stream = lines(spark, folder, "id int")
    drain(stream, folder)
    drain(stream, folder)
    assert rows(spark.read.parquet(str(folder / "out"))) == [(1,), (2,)]
    deliver(folder, "2.json", [{"id": 3}])
    drain(stream, folder)
    assert rows(spark.read.parquet(str(folder / "out"))) == [(1,), (2,), (3,)]


def test_fresh_checkpoint_and_path_replay_everything(spark, folder):
    deliver(folder, "1.json", [{"id": 1}])
    stream = lines(spark, folder, "id int")
    drain(stream, folder)
    drain(stream, folder, "again", "other")
    assert rows(spark.read.parquet(str(folder / "again"))) == [(1,)]


def test_landing_json_lines_in_bounded_files(spark, folder):
    deliver(folder, "1.json", [{"id": i} for i in range(10)])
    drain(lines(spark, folder, "id int"), folder, file_format="json", rows_per_file=4)
    landed = read_json_records(spark, str(folder / "out"), "id int")
    assert landed.count() == 10
    per_file = landed.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 4


def test_batches_and_file_metrics(spark, folder):
    for i in range(3):
        deliver(folder, f"{i}.json", [{"id": i, "v": "x"}] * (i + 1))
    drain(lines(spark, folder, "id int, v string", per_trigger=1), folder)
    metrics = landed_file_metrics(spark.read.parquet(str(folder / "out"))).collect()
    assert sum(m.n_rows for m in metrics) == 6
    assert all(m.n_columns == 2 and m.n_bytes > 0 for m in metrics)


def test_counts_are_complete_over_many_batches_and_a_restart(spark, folder):
    stream = lines(spark, folder, "id int", per_trigger=1)
    out, metrics, checkpoint = (str(folder / n) for n in ("out", "metrics", "checkpoint"))
    for start, stop in ((0, 60), (60, 106)):
        for i in range(start, stop):
            deliver(folder, f"{i}.json", [{"id": i}])
        land_counted(stream, out, metrics, checkpoint).awaitTermination()
    counted = landed_batches(spark, metrics)
    assert counted.count() == 106 and counted.agg(F.sum("n_rows")).first()[0] == 106
    assert sorted(values(spark.read.schema("id int").parquet(out).select("id"))) == list(range(106))
    # A batch whose commit was lost is written again and replaces itself.
    (folder / "checkpoint" / "commits" / "105").unlink()
    (folder / "checkpoint" / "commits" / ".105.crc").unlink()
    land_counted(stream, out, metrics, checkpoint).awaitTermination()
    assert landed_batches(spark, metrics).agg(F.sum("n_rows")).first()[0] == 106
    assert spark.read.schema("id int").parquet(out).count() == 106


def test_observed_metrics_are_complete_over_a_restart_without_a_second_read(spark, folder):
    out, metrics, checkpoint = (str(folder / p) for p in ("out", "metrics", "checkpoint"))
    for number in range(3):
        for k in range(2):
            deliver(folder, f"{number}-{k}.json", [{"id": 10 * number + k}, {"id": None}])
        stream = lines(spark, folder, "id int", per_trigger=1)
        land_observed(stream, out, metrics, checkpoint, {"low": F.min("id"), "n_ids": F.count("id")}).awaitTermination()
    found = observed_batches(spark, metrics)
    assert rows(found.select("n_rows", "low", "n_ids")) == sorted((2, 10 * n + k, 1) for n in range(3) for k in range(2))
    assert sorted(values(found.select("batch_id"))) == list(range(6))
    # A batch whose commit was lost is written again, and its metrics with it.
    (folder / "checkpoint" / "commits" / "5").unlink()
    (folder / "checkpoint" / "commits" / ".5.crc").unlink()
    land_observed(stream, out, metrics, checkpoint, {"low": F.min("id"), "n_ids": F.count("id")}).awaitTermination()
    assert observed_batches(spark, metrics).agg(F.sum("n_rows")).first()[0] == 12 == spark.read.schema("id int").parquet(out).count()


def test_clean_and_stamp(spark, folder):
    deliver(folder, "1.json", [{"id": 1, "v": "x"}, {"id": 2}, {"v": "y"}])
    drain(clean_and_stamp(lines(spark, folder, "id int, v string")), folder)
    landed = spark.read.parquet(str(folder / "out"))
    assert rows(landed.select("id", "v")) == [(1, "x")]
    assert landed.filter("timestamp IS NULL").count() == 0


@pytest.mark.parametrize("spread", [1, 4])
def test_redelivered_records_land_once(spark, folder, spread):
    deliver(folder, "1.json", [{"id": 1}, {"id": 2}, {"id": 1}])
    stream = dedupe_stream(lines(spark, folder, "id int", per_trigger=1), ["id"], spread=spread)
    drain(stream, folder)
    assert rows(spark.read.parquet(str(folder / "out"))) == [(1,), (2,)]
    # Redelivery in a later batch, after a restart.
    deliver(folder, "2.json", [{"id": 2}, {"id": 3}])
    drain(stream, folder)
    assert rows(spark.read.parquet(str(folder / "out"))) == [(1,), (2,), (3,)]


def test_a_key_redelivered_for_a_third_of_all_records(spark, folder):
    deliver(folder, "1.json", [{"id": 0 if i % 3 == 0 else i} for i in range(3000)])
    drain(dedupe_stream(lines(spark, folder, "id int"), ["id"]), folder)
    landed = spark.read.parquet(str(folder / "out"))
    assert landed.count() == 2001 and landed.distinct().count() == 2001


def test_event_time_drops_records_behind_the_watermark(spark, folder):
    """As documented: with event time the delay must cover the largest lateness."""
    schema = "id int, ts timestamp"
    deliver(folder, "1.json", [{"id": 1, "ts": "2020-01-01T12:00:00Z"}])
    stream = dedupe_stream(lines(spark, folder, schema, per_trigger=1), ["id"], "ts", "1 hour")
    drain(stream, folder)
    deliver(folder, "2.json", [
        {"id": 2, "ts": "2020-01-01T11:30:00Z"}, {"id": 3, "ts": "2020-01-01T10:00:00Z"},
        {"id": 1, "ts": "2020-01-01T12:10:00Z"},
    ])
    drain(stream, folder)
    assert [r[0] for r in rows(spark.read.parquet(str(folder / "out")).select("id"))] == [1, 2]


def test_messages_decode_in_a_stream(spark, folder):
    deliver(folder, "1.json", [{"key": "1", "value": '{"Order_Id": "123", "Order_Date": "01/15/2020 10:30"}'}])
    messages = lines(spark, folder, "key string, value string")
    drain(decode_messages(messages, all_text(["Order_Id", "Order_Date"])), folder)
    assert rows(spark.read.parquet(str(folder / "out"))) == [("123", "01/15/2020 10:30", "1")]


def test_kafka_options():
    assert kafka_source_options("b:9092") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "supply-chain-orders", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "2000000",
    }
    assert "maxOffsetsPerTrigger" not in kafka_source_options("b:9092", max_rows_per_trigger=None)
    bounded = kafka_source_options("b:9092", start="latest", max_rows_per_trigger=20_000, group_id="g")
    assert bounded["maxOffsetsPerTrigger"] == "20000" and bounded["kafka.group.id"] == "g"
    assert bounded["startingOffsets"] == "latest"


def test_streaming_publish_needs_a_checkpoint(spark, folder):
    with pytest.raises(ValueError, match="checkpoint"):
        publish(lines(spark, folder, "id int"), "b:9092")
