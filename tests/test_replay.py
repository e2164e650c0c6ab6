import json
import os
import shutil
from collections import Counter, defaultdict
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

import __spark_entry__ as spark_entry
from chirrup.operators.bronze import bronze
from chirrup.sources.records import read_tweets
from chirrup.streaming import paced
from chirrup.streaming.paced import PacedReader, Part, paced_lines
from chirrup.streaming.replay import keyed_records, numbered, replay, replay_in_order
from tests.compare import mismatch
from tests.fixture import TWEETS, bronze_df, predictions_df, rows, tweets_df
from tests.test_records import KEYS, lines


def send(spark, tmp_path, **options):
    query = replay(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return query


@pytest.fixture
def source(tmp_path):
    (tmp_path / "in").mkdir()
    records = [dict(zip(KEYS, tweet)) for tweet in TWEETS]
    dated = [record | {"Date": f"2023-01-0{1 + record['id'] % 2}", "extra": {"a": [1]}} for record in records[:5]]
    (tmp_path / "in" / "dated.json").write_text(lines(dated[:3]) + "\n  \n" + lines(dated[3:]))
    (tmp_path / "in" / "undated.json").write_text(lines(records[5:]))
    return tmp_path


def test_replayed_records_equal_the_batch_read_and_feed_bronze(spark, source):
    send(spark, source)
    replayed = read_tweets(spark, str(source / "out"))
    assert rows(replayed) == rows(read_tweets(spark, str(source / "in"))) == rows(tweets_df(spark))
    assert rows(bronze(replayed, predictions_df(spark))) == rows(bronze_df(spark))


def test_keys_and_whole_payloads(spark, source):
    send(spark, source)
    payloads = [json.loads(row.value) for row in spark.read.text(str(source / "out")).collect()]
    assert {record["key"] for record in payloads} == {"2023-01-01", "2023-01-02", "default"}
    assert sum(record["key"] == "default" for record in payloads) == 5
    assert min(payloads, key=lambda record: record["id"])["extra"] == {"a": [1]}
    assert all(record.get("Date", "default") == record["key"] for record in payloads)


def test_another_key_field(spark, source):
    send(spark, source, key="user_id")
    got = spark.read.schema("key string").json(str(source / "out")).collect()
    assert {row.key for row in got} == {"1", "2", "3", "4", "5", "6", "7", "8", "10", "default"}


@pytest.mark.parametrize("line, stored", [
    ('{"Date": "", "id": 1}', '{"Date": "", "id": 1,"key":""}'),
    ('{ }', '{"key":"default"}'),
    ('{"Date": null}\t', '{"Date": null,"key":"default"}'),
    ('{"Date": "a\\"}", "b": {}}', '{"Date": "a\\"}", "b": {},"key":"a\\"}"}'),
])
def test_the_key_is_the_last_field_of_the_stored_record(spark, tmp_path, line, stored):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text(line + "\n")
    send(spark, tmp_path)
    assert [row.value for row in spark.read.text(str(tmp_path / "out")).collect()] == [stored]


def test_many_keys_make_few_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for part in range(4):
        (tmp_path / "in" / f"{part}.json").write_text(lines([{"id": i, "user_id": i} for i in range(part, 2000, 4)]))
    send(spark, tmp_path, key="user_id")
    assert spark.read.schema("key string").json(str(tmp_path / "out")).distinct().count() == 2000
    assert len(list((tmp_path / "out").glob("**/*.txt"))) <= 4


def test_a_rerun_adds_only_new_files(spark, source):
    send(spark, source)
    send(spark, source)
    out = str(source / "out")
    assert spark.read.text(out).count() == 10
    (source / "in" / "late.json").write_text(lines([dict(zip(KEYS, TWEETS[0]))]))
    send(spark, source)
    assert spark.read.text(out).count() == 11


def test_files_per_trigger_set_the_pace(spark, source):
    assert send(spark, source, max_files_per_trigger=1).lastProgress["batchId"] == 1
    assert spark.read.text(str(source / "out")).count() == 10


def test_a_paced_stream_runs_until_it_is_stopped(spark, source):
    paths = [str(source / name) for name in ("in", "out", "checkpoint")]
    query = replay(spark, *paths, max_files_per_trigger=1, interval="1 second")
    query.processAllAvailable()
    assert query.isActive
    (source / "in" / "late.json").write_text(lines([dict(zip(KEYS, TWEETS[0]))]))
    query.processAllAvailable()
    query.stop()
    assert rows(read_tweets(spark, str(source / "out"))) == sorted([*TWEETS, TWEETS[0]], key=repr)


@pytest.mark.parametrize("line", [
    '{"id": 5, "tweet": ', "{'id': 5}", '{"Date": "x", "tweet": "cut', "no record", '{"id": 5} and more', "null", "[5]",
    '{"id": 5}{"id": 6}', '{"id": 5}, {"id": 6}',
])
def test_a_malformed_line_fails_the_replay(spark, source, line):
    (source / "in" / "bad.json").write_text(line + "\n")
    with pytest.raises(StreamingQueryException):
        send(spark, source)


def test_keyed_records_of_a_batch(spark):
    df = spark.createDataFrame([('{"Date": 5}',), ("\t",), ('  {"Date": "x", "a": 1} ',), ('{"a": null}',)], "value string")
    assert rows(keyed_records(df)) == [
        ("5", '{"Date": 5}'), ("default", '{"a": null}'), ("x", '{"Date": "x", "a": 1}')
    ]


def write_records(folder, name, ids, time=None, **extra):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(json.dumps({"id": i, **{k: f(i) for k, f in extra.items()}}) + ("\n  \n" if i % 7 == 0 else "\n") for i in ids))
    if time:
        os.utime(path, (time, time))


def drained(query):
    query.processAllAvailable()
    progress = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    return progress


def ids_of(spark, path):
    return sorted(row.id for row in spark.read.schema("id long").json(str(path)).collect())


def test_records_per_trigger_split_one_file(spark, tmp_path):
    write_records(tmp_path / "in", "all.json", range(10_000))
    paths = [str(tmp_path / name) for name in ("in", "out", "checkpoint")]
    assert drained(replay(spark, *paths, records_per_trigger=1000)) == [1000] * 10
    assert ids_of(spark, tmp_path / "out") == list(range(10_000))


def test_a_restart_within_a_file_loses_and_repeats_nothing(spark, tmp_path):
    write_records(tmp_path / "in", "b.json", range(2500), time=1000)
    write_records(tmp_path / "in", "_hidden.json", range(5), time=1000)
    paths = [str(tmp_path / name) for name in ("in", "out", "checkpoint")]
    assert drained(replay(spark, *paths, records_per_trigger=1000)) == [1000, 1000, 500]
    assert drained(replay(spark, *paths, records_per_trigger=1000)) == []
    # A file that sorts before by name but is newer, and more than a batch of them.
    for k in range(4):
        write_records(tmp_path / "in", f"a{k}.json", range(2500 + 400 * k, 2900 + 400 * k), time=2000 + k)
    query = replay(spark, *paths, records_per_trigger=300)
    while not any(p["numInputRows"] for p in query.recentProgress):
        pass
    query.stop()  # wherever it is
    drained(replay(spark, *paths, records_per_trigger=700))
    assert ids_of(spark, tmp_path / "out") == list(range(4100))


def test_a_batch_that_was_not_committed_is_done_again_alike(spark, tmp_path):
    write_records(tmp_path / "in", "all.json", range(900))
    paths = [str(tmp_path / name) for name in ("in", "out", "checkpoint")]
    assert drained(replay(spark, *paths, records_per_trigger=300)) == [300] * 3
    (tmp_path / "checkpoint" / "commits" / "2").unlink()
    (tmp_path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    drained(replay(spark, *paths, records_per_trigger=300))
    assert ids_of(spark, tmp_path / "out") == list(range(900))


@pytest.mark.parametrize("content", ["", "\n\n", "a", "a\n", "a\r\nb\r\n\r\nc", "\n\na\n \n" * 5, "\u00e9\u6f22\n" * 9])
@pytest.mark.parametrize("records, per_task", [(1, 1), (2, 3), (100, 2), (100, 100)])
def test_offsets_cover_each_line_once(tmp_path, content, records, per_task):
    (tmp_path / "x").write_text(content, newline="")
    (tmp_path / "y").write_text(content, newline="")
    want = [line.strip("\r") for line in (content + "\n" + content).split("\n") if line.strip()]
    reader, got, start = PacedReader(str(tmp_path), records, per_task), [], None
    while True:
        begin = start or reader.initialOffset()
        start = reader.latestOffset()
        # Another reader, as after a restart, plans the same batch.
        again = PacedReader(str(tmp_path), records, per_task).partitions(begin, start)
        batch = [value for part in reader.partitions(begin, start) for rows in reader.read(part) for value in rows.column(0).to_pylist()]
        assert batch == [value for part in again for rows in reader.read(part) for value in rows.column(0).to_pylist()]
        assert len(batch) <= records
        if start == begin:
            break
        got += batch
    assert got == want


def test_sequences_follow_the_input_over_batches_and_restarts(spark, tmp_path):
    """Keys have numbers without a gap; the key that most records share is dealt over lanes."""
    day = lambda i: f"day{i % 3}" if i % 4 == 0 else None
    paths = [str(tmp_path / name) for name in ("in", "out", "checkpoint")]
    options = {"records_per_trigger": 700, "lanes": 4}
    write_records(tmp_path / "in", "z.json", range(2000), time=1000, Date=day)
    drained(replay_in_order(spark, *paths, **options))
    write_records(tmp_path / "in", "a.json", range(2000, 3000), time=2000, Date=day)
    drained(replay_in_order(spark, *paths, **options))
    rows = spark.read.schema("id long, key string, lane int, sequence long").json(paths[1]).collect()
    assert sorted(row.id for row in rows) == list(range(3000))
    found = defaultdict(list)
    for row in rows:
        assert row.key == (day(row.id) or "default")
        found[row.key, row.lane].append((row.sequence, row.id))
    assert set(found) == {("day0", 0), ("day1", 0), ("day2", 0), *(("default", lane) for lane in range(4))}
    for own in found.values():
        assert [sequence for sequence, _ in sorted(own)] == list(range(len(own)))
        assert [i for _, i in sorted(own)] == sorted(i for _, i in own)
    sizes = [len(own) for (key, _), own in found.items() if key == "default"]
    assert max(sizes) < 1.5 * min(sizes)


def test_the_query_deals_records_without_a_user_over_lanes(spark, tmp_path):
    """The query `replay_in_order`, over events of which two thirds have no user, equals its SQL."""
    n = 600
    events = {
        "event_id": pa.array([*range(n - 1), None], pa.int64()), "ts": pa.array([datetime(2024, 1, 1)] * n, pa.timestamp("us")),
        "user_id": pa.array([k % 5 for k in range(n)], pa.int64()), "event_type": ["view"] * n,
        "value": [50.0 if k % 3 == 0 else 0.5 for k in range(n)],
    }
    numbers = lambda kind, *names: {name: pa.array([1, 2], kind) for name in names}
    documents = numbers(pa.int64(), "doc_id") | {"text": ["a", "b"]}
    labels = numbers(pa.int64(), "doc_id") | numbers(pa.int32(), "quality", "toxic")
    for name, columns in (("events", events), ("documents", documents), ("labels", labels)):
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
    found = spark_entry.queries()["replay_in_order"](spark, str(tmp_path)).collect()
    sizes = Counter(row.lane for row in found if row.key == "default")
    assert len(found) == n and set(sizes) == set(range(8)) and max(sizes.values()) < 100
    assert {row.lane for row in found if row.key != "default"} == {0}
    assert mismatch(spark, str(tmp_path), "replay_in_order") is None


def test_many_keys_are_numbered_by_few_calls(spark, tmp_path):
    """The state has a row for each bucket, not for each key; keys meet in buckets, and one of them is empty."""
    key = lambda i: "" if i % 9 == 0 else f"k{i % 500}"
    paths = [str(tmp_path / name) for name in ("in", "out", "checkpoint")]
    write_records(tmp_path / "in", "a.json", range(1300), time=1000, Date=key)
    lines = paced_lines(spark, paths[0], 900)
    sent = numbered(keyed_records(lines, "Date", "time", "file", "record"), buckets=16)
    query = sent.writeStream.format("json").option("checkpointLocation", paths[2]).start(paths[1])
    query.processAllAvailable()
    (state,) = query.lastProgress["stateOperators"]
    query.stop()
    assert state["numRowsTotal"] <= 16
    found = defaultdict(list)
    for row in spark.read.schema("key string, value string, lane int, sequence long").json(paths[1]).collect():
        assert row.lane == 0
        found[row.key].append((row.sequence, json.loads(row.value)["id"]))
    want = defaultdict(list)
    for i in range(1300):
        want[key(i)].append((len(want[key(i)]), i))
    assert {name: sorted(own) for name, own in found.items()} == want


def test_a_missing_key_is_a_key(spark, tmp_path):
    """A null key has numbers of its own over the batches."""
    write_records(tmp_path / "in", "a.json", range(90), time=1000)
    lines = paced_lines(spark, str(tmp_path / "in"), 40)
    keyed = lines.selectExpr("if(record % 2 = 0, NULL, 'NaN') AS key", "value", "time", "file", "record")
    query = numbered(keyed).writeStream.format("json").option("checkpointLocation", str(tmp_path / "checkpoint")).start(str(tmp_path / "out"))
    query.processAllAvailable()
    query.stop()
    rows = spark.read.schema("key string, record long, sequence long").json(str(tmp_path / "out")).collect()
    assert sorted((row.record, row.key, row.sequence) for row in rows) == [(i, "NaN" if i % 2 else None, i // 2) for i in range(90)]


@pytest.mark.parametrize("block", [1, 2, 5])
@pytest.mark.parametrize("content", ["", "\n \n", "abc", "a\r\nbcdefg\r\n\r\nc", "\n\na\n \n" * 5 + " ", "\u00e9\u6f22\n" * 9])
@pytest.mark.parametrize("records, per_task", [(1, 1), (2, 3), (100, 2)])
def test_lines_may_pass_the_blocks_of_the_driver(tmp_path, monkeypatch, content, records, per_task, block):
    (tmp_path / "x").write_text(content, newline="")
    (tmp_path / "y").write_text(content, newline="")

    def plan():
        reader, planned, start = PacedReader(str(tmp_path), records, per_task), [], None
        while True:
            begin, start = start or reader.initialOffset(), reader.latestOffset()
            parts = reader.partitions(begin, start)
            planned.append((start, [(part.place, part.end) for part in parts]))
            if start == begin:
                return planned, [v for _, own in planned for place, end in own for rows in reader.read(Part(place, end)) for v in rows.column(0).to_pylist()]

    planned, got = plan()
    monkeypatch.setattr(paced, "BLOCK", block)
    assert plan() == (planned, got)
    assert got == [line.strip("\r") for line in (content + "\n" + content).split("\n") if line.strip()]


BAD = {
    '{"id": 5, "tweet":': "no JSON", "{'id': 5}": "no JSON", "no record": "no JSON", '{"id": 5} and more': "no JSON", "null": "not one record",
    "[5]": "no JSON", '{"id": 5}, {"id": 6}': "not one record", '{"id": 5}]': "not one record", "],[": "not one record",
}


@pytest.mark.parametrize("options", [{}, {"records_per_trigger": 4}, {"max_files_per_trigger": 1}])
def test_bad_lines_go_aside(spark, source, options):
    (source / "in" / "bad.json").write_text("\n".join(BAD) + '\n{"id": 77, "Date": "d"}\n')
    paths = [str(source / name) for name in ("in", "out", "checkpoint")]

    def send_all():
        query = replay(spark, *paths, rejects=str(source / "rejects"), **options)
        drained(query) if "records_per_trigger" in options else query.awaitTermination()

    def check():
        sent = spark.read.schema("id long, key string").json(paths[1]).select("id", "key").collect()
        assert len(sent) == len(TWEETS) + 1 and ("d" in {row.key for row in sent})
        rejects = spark.read.json(str(source / "rejects")).select("value", "file", "reason").collect()
        assert {row.value: row.reason for row in rejects} == BAD and len(rejects) == len(BAD)
        assert all(row.file.endswith("bad.json") for row in rejects)

    send_all()
    check()
    # The last batch is done again, as after a crash between its writes and its commit.
    last = max((source / "checkpoint" / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    shutil.rmtree(source / "rejects" / f"batch={last.name}")
    send_all()
    check()
    assert len(read_tweets(spark, paths[1]).columns) == len(KEYS)
