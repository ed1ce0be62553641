import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakemill.operators import events as E
from lakemill.streaming import events as S

ROW = "event_id string, trip_id string, fare_amount double, event_time string, event_type string"
# The five-day validation rows.
DAYS = [(f"e{i}", f"t{i}", 10.0 * i, f"2024-01-0{i}T00:00:00", "batch_seed") for i in range(1, 6)]


def lines(spark, *messages):
    return spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in messages], "value string")


def row_message(day):
    keys = [c.split()[0] for c in ROW.split(", ")]
    return {"message_type": "row", "event_id": day[0], "row": dict(zip(keys, day))}


def test_malformed_and_unknown_lines_are_skipped(spark):
    got = E.parse_envelope(lines(spark, "{broken", '"text"', {"message_type": "ping"}, {"message_type": "row", "event_id": "a"}))
    assert [r.event_id for r in got.collect()] == ["a"]


def test_batch_rows_use_trip_id_as_fallback(spark):
    message = {"message_type": "batch", "batch_id": "b", "rows": [{"event_id": "", "trip_id": "t"}, {"event_id": "e", "fare_amount": "x"}]}
    got = rows(E.explode_batches(E.parse_envelope(lines(spark, message))).select("event_id", "fare_amount"))
    assert got == [("e", None), ("t", None)]
    own = {"message_type": "row", "event_id": "m", "row": {"event_id": "r"}}
    assert E.explode_batches(E.parse_envelope(lines(spark, own))).first().event_id == "m"


def test_missing_ids_drop_or_keep(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4), ("b", 5)], "event_id string, n int")
    state = spark.createDataFrame([("b",)], "event_id string")
    assert [r.n for r in E.new_events(df, state, ["n"]).collect()] == [1]
    assert sorted(r.n for r in E.new_events(df, state, ["n"], "keep").collect()) == [1, 3, 4]
    with pytest.raises(ValueError):
        E.new_events(df, state, missing="other")


def test_stable_ids_do_not_depend_on_column_order(spark):
    a = spark.createDataFrame([(1, "x", None)], "n int, s string, event_id string")
    first = E.with_event_id(a, "rows", "n").first().event_id
    second = E.with_event_id(a.select("event_id", "s", "n"), "rows", "n").first().event_id
    assert first == second and first.startswith("row-rows-00000001-") and len(first) == len("row-rows-00000001-") + 16
    assert E.with_event_id(a.withColumn("event_id", F.lit("own")), "rows", "n").first().event_id == "own"


def test_gate():
    assert pytest.raises(ValueError, E.should_calculate, "other", None)


def test_relay_payloads(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, "5"), (3, "oops"), (4, "[1,2]")], "n int, body string")
    got = {r.sequence: (r.payload_kind, r.payload, r.total) for r in E.relay(df, ["n"]).collect()}
    assert got[1] == ("object", '{"a":1}', 4)
    assert got[2] == ("value", '{"message":5,"sequence":2}', 4)
    assert got[3] == ("raw", '{"raw_body":"oops"}', 4)
    assert got[4] == ("value", '{"message":[1,2],"sequence":4}', 4)


def test_snapshot_event_paths(spark):
    payload = spark.createDataFrame([("{}",)], "payload string")
    event = E.snapshot_event(payload, "s3a://gold/", "s", "d").first()
    assert event.object_key == "screen/d.json" and event.artifact_uri == "s3a://gold/screen/d.json"
    with pytest.raises(ValueError):
        E.snapshot_event(payload, "no-uri", "s", "d")


def test_parity_kinds(spark):
    truth = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "k string")
    built = spark.createDataFrame([("a",), ("a",), ("c",), ("d",)], "k string")
    assert {r.key: r.status for r in E.parity(truth, built, "k").collect()} == {
        "a": "duplicate", "b": "missing", "c": "short", "d": "extra",
    }


def test_five_days_one_by_one_equal_the_file(spark, tmp_path):
    """Rows sent one at a time, twice, end in the histogram of the whole file."""
    box = tmp_path / "in"
    box.mkdir()
    for i, day in enumerate(DAYS + DAYS[:2]):
        (box / f"{i:02d}.json").write_text(json.dumps(row_message(day)) + "\n")
    made = []
    stream = S.event_stream(spark, str(box), 1)
    query = S.stream_histogram(stream, str(tmp_path / "s"), str(tmp_path / "c"), 0.0, lambda i, df: made.append((i, df.collect())))
    assert query.awaitTermination(600)
    file = spark.createDataFrame(DAYS, ROW)
    truth = {r.bucket: r.cnt for r in H_ceil(file).collect()}
    assert len(made) == 5 and {r.bucket: r.cnt for r in made[-1][1]} == truth
    assert [sum(r.cnt for r in snapshot) for _, snapshot in made] == [1, 2, 3, 4, 5]
    state = S.read_state(spark, str(tmp_path / "s" / "rows"), S.ROW_STATE)
    assert E.parity(file, state, "event_id").count() == 0
    # A restart with nothing new changes nothing.
    again = S.stream_histogram(S.event_stream(spark, str(box), 1), str(tmp_path / "s"), str(tmp_path / "c"), 0.0)
    assert again.awaitTermination(600)
    assert S.read_state(spark, str(tmp_path / "s" / "rows"), S.ROW_STATE).count() == 5


def H_ceil(df):
    from lakemill.operators.histograms import ceil_histogram

    return ceil_histogram(df, "fare_amount", relative_error=0.0)


def test_batches_are_skipped_once_seen(spark, tmp_path):
    message = {"message_type": "batch", "batch_id": "b1", "rows": [{"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"}]}
    path = str(tmp_path / "s")
    assert S.ingest_lines(lines(spark, message, message), 0, path).count() == 2
    more = dict(message, rows=[{"event_id": "z"}])
    assert S.ingest_lines(lines(spark, more), 1, path).count() == 0  # the batch id is known
    empty = dict(message, batch_id="", rows=[{"event_id": "z"}])
    assert S.ingest_lines(lines(spark, empty), 2, path).count() == 0
    assert S.ingest_lines(lines(spark, message), 0, path).count() == 2  # a repeated micro-batch


def test_cumulative_and_snapshot_at(spark):
    df = spark.createDataFrame(DAYS, ROW)
    built = E.cumulative_hist(df, "fare_amount", ["event_time", "event_id"], 40.0)
    assert [r.snapshot for r in built.orderBy("row_count").collect()] == [f"row_day{i}" for i in range(1, 6)]
    assert {r.bucket: r.cnt for r in E.snapshot_at(built, 5).collect()} == {10: 1, 20: 1, 30: 1, 39: 2}


def test_watermark_variant_plans(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    stream = S.event_stream(spark, str(box)).select(F.col("value").alias("event_id"), F.current_timestamp().alias("event_time"))
    assert S.dedupe_stream(stream).isStreaming


def test_messages_one_by_one(spark, tmp_path):
    from lakemill.plans.realtime import process_message

    path = str(tmp_path / "state")
    spark.createDataFrame(DAYS, ROW).write.parquet(str(tmp_path / "days.parquet"))
    meta = {"file_event_id": "file-1", "source_path": str(tmp_path / "days.parquet"), "source_name": "days.parquet"}
    file = E.parse_envelope(lines(spark, {"message_type": "file", "event_id": "file-1", "metadata": meta})).first()
    summary, truth = process_message(spark, file, path, relative_error=0.0)
    assert summary.should_calculate and not summary.duplicate
    again, nothing = process_message(spark, file, path, outputs_ready=True)
    assert again.duplicate and nothing is None
    for n, day in enumerate(DAYS, start=1):
        message = E.parse_envelope(lines(spark, row_message(day))).first()
        summary, built = process_message(spark, message, path, relative_error=0.0)
        assert (summary.applied_row_count, summary.total_row_count_after) == (1, n)
    truth, built = truth.first(), built.first()
    assert (truth.counts, truth.bin_edges, truth.row_count) == (built.counts, built.bin_edges, built.row_count)
    repeat, made = process_message(spark, message, path, outputs_ready=True)
    assert repeat.duplicate and made is None
    assert process_message(spark, message, path, outputs_ready=False)[1] is not None
    bare = E.parse_envelope(lines(spark, {"message_type": "row", "event_id": "x", "row": {"fare_amount": "bad"}})).first()
    assert process_message(spark, bare, path)[0].applied_row_count == 1  # its id is made from the source
    with pytest.raises(ValueError):
        process_message(spark, E.parse_envelope(lines(spark, {"message_type": "text"})).first(), path)


def test_ids_are_known_through_merges_and_repeats(spark, tmp_path):
    from lakemill.streaming import ids as I

    path = str(tmp_path / "ids")
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "event_id string")
    known = set()
    for batch in range(18):
        I.compact_ids(spark, path, batch)
        names = [f"e{batch}", f"e{batch}-b", "e0"]
        seen = {r.event_id for r in I.seen_ids(frame(names), path, batch).collect()}
        assert known & set(names) <= seen <= known  # of the buckets asked for, all; and nothing of this batch
        I.append_ids(frame(n for n in names if n not in seen), path, batch)
        known |= set(names)
    found = I.folders(spark, path)
    assert {level for level, *_ in found} == {0, 1}
    assert max(sum(1 for l, b, *_ in found if (l, b) == key) for key in {f[:2] for f in found}) <= I.FAN_IN
    # A merge that is cut short after its write: ids lie twice, a repeat of the batch sees and keeps the same ones.
    I.append_ids(frame(["e3"]), path, 17)
    I.compact_ids(spark, path, 24)
    again = {r.event_id for r in I.seen_ids(frame(["e3", "new"]), path, 24).collect()}
    assert "e3" in again and "new" not in again
    few = I.seen_ids(frame(["e5"]), path, 24)
    assert len(few.inputFiles()) <= I.FAN_IN  # one bucket of 64


def test_repeated_batch_after_a_merge(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame = lambda *names: spark.createDataFrame([(n, n, 1.0, "2024", "x") for n in names], ROW)
    for batch in range(9):
        assert S.apply_batch(frame("a", f"b{batch}"), batch, path).count() == (2 if batch == 0 else 1)
    assert S.apply_batch(frame("a", "b8", "b2"), 8, path).count() == 1  # batch 8 again, behind the merge
    assert S.read_state(spark, path, S.ROW_STATE).select("event_id").distinct().count() == 10
    assert S.read_state(spark, path, S.ROW_STATE).count() == 10


def test_stream_stopped_and_started_gives_each_event_once(spark, tmp_path):
    from lakemill.streaming.once import first_of_ids

    box = tmp_path / "in"
    box.mkdir()
    for i in range(4):
        text = "\n".join(json.dumps(row_message(day)) for day in (DAYS[i], DAYS[0], DAYS[i]))
        (box / f"{i}.json").write_text(text + "\n")

    def start():
        rows = E.explode_batches(E.parse_envelope(S.event_stream(spark, str(box), 1)))
        return first_of_ids(rows).writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", str(tmp_path / "offsets")
        )

    out = str(tmp_path / "out")
    query = start().start(out)
    while not query.recentProgress or query.lastProgress["batchId"] < 1:
        assert query.exception() is None
        query.awaitTermination(1)
    query.stop()  # somewhere between the batches
    last = start().trigger(availableNow=True).start(out)
    assert last.awaitTermination(600)
    ids = sorted(r.event_id for r in spark.read.parquet(out).select("event_id").collect())
    whole = E.explode_batches(E.parse_envelope(spark.read.text(str(box))))
    assert ids == sorted(r.event_id for r in E.new_events(whole, spark.createDataFrame([], "event_id string")).collect())


def test_a_hundred_thousand_ids_are_told_apart_in_a_minute(spark, tmp_path):
    from lakemill.streaming.once import first_of_ids

    n, box, out = 100_000, str(tmp_path / "in"), str(tmp_path / "out")
    sent = spark.range(n).select(F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") % 7).alias("n"))
    for again in range(2):
        sent.withColumn("again", F.lit(again)).coalesce(1).write.mode("append").parquet(box)
    events = spark.readStream.schema("event_id string, n bigint, again int").option("maxFilesPerTrigger", 1).parquet(box)
    query = first_of_ids(events).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "offsets"))
    query = query.trigger(availableNow=True).start(out)
    try:
        assert query.awaitTermination(60)
    finally:
        query.stop()
    got = spark.read.parquet(out)
    assert got.columns == ["event_id", "n", "again"] and got.select("again").distinct().count() == 1
    assert got.drop("again").exceptAll(sent).isEmpty() and sent.exceptAll(got.drop("again")).isEmpty()


def test_late_events_of_a_stream_with_a_watermark_pass(spark, tmp_path):
    from lakemill.streaming.once import first_of_ids

    box, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows_ in ([("a", 5), ("", 5), (None, 5)], [("b", 5)], [("a", 1), ("c", 1), ("d", 5)]):
        made = spark.createDataFrame(rows_, "event_id string, day int")
        made.select("event_id", F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)).alias("t")).coalesce(
            1
        ).write.mode("append").parquet(box)
    events = spark.readStream.schema("event_id string, t timestamp").option("maxFilesPerTrigger", 1).parquet(box)
    query = first_of_ids(events.withWatermark("t", "1 hour")).writeStream.format("parquet")
    query = query.option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start(out)
    assert query.awaitTermination(600)
    assert sorted((r.event_id, r.t.day) for r in spark.read.parquet(out).collect()) == [("a", 5), ("b", 5), ("c", 1), ("d", 5)]


def test_events_once_waits_for_its_stream(spark, tmp_path, monkeypatch):
    from pyspark.sql.streaming import StreamingQuery

    from __spark_entry__ import queries

    wait = StreamingQuery.awaitTermination

    def time_is_up(query, timeout=None):
        return wait(query) if timeout is None else query.stop() or False

    monkeypatch.setattr(StreamingQuery, "awaitTermination", time_is_up)
    made = spark.createDataFrame([(i, i % 3, "error" if i % 2 else "view", float(i)) for i in range(40)], "event_id bigint, user_id bigint, event_type string, value double")
    made.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    got = queries()["stream_events_once"](spark, str(tmp_path))
    assert sorted(int(r.event_id) for r in got.collect()) == list(range(40))
