"""Files, routing, JDBC texts and stream restarts."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.session import new_path
from tillcast.sources import documents, files, jdbc
from tillcast.streaming import arrivals


def test_one_predicate_per_store_and_no_injected_text():
    made = jdbc.key_predicates([1, 7], "location_num = {key} ORDER BY business_date DESC")
    assert made == [f"location_num = {k} ORDER BY business_date DESC" for k in (1, 7)]
    with pytest.raises(ValueError):
        jdbc.key_predicates(["1 OR 1 = 1"])


def test_jdbc_calls_spark_with_one_partition_per_key(spark):
    calls = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            calls.update(url=url, table=table, predicates=predicates, properties=properties)
            return "frame"

    class Session:
        read = Reader()

    got = jdbc.read_jdbc_by_key(Session(), "jdbc:x", "(select 1) t", [1, 2])
    assert got == "frame" and calls["predicates"] == ["location_num = 1", "location_num = 2"]


def test_store_folders_survive_append(spark):
    path = new_path(spark, "by-store")
    df = spark.createDataFrame([(1, 5), (2, 6)], "location_num int, x int")
    files.write_by_store(df, path, "overwrite")
    files.write_by_store(df.where("location_num = 2"), path, "append")
    back = spark.read.schema("location_num int, x int, store_num int").option("header", True)
    assert sorted(tuple(r) for r in back.csv(path).collect()) == [(1, 5, 1), (2, 6, 2), (2, 6, 2)]


def test_single_file_is_one_sorted_file(spark):
    path = new_path(spark, "single")
    files.write_single(spark.range(100).repartition(8), path, ["id"])
    assert [int(r.id) for r in spark.read.option("header", True).csv(path).collect()] == list(
        range(100)
    )


def test_compaction_keeps_what_it_can_and_lists_the_rest(spark, tmp_path):
    (tmp_path / "a.csv").write_text('location_num,note,flag\n1,"x, ""y""",0\n3,,1')
    (tmp_path / "b.csv").write_text("flag,location_num\n,2\n\n")
    (tmp_path / "c.csv").write_text("other,location_num\r\n9,4\r\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text('note,location_num\n"two\nlines, quoted",5\n"one",6\n')
    (tmp_path / "f.csv").write_text("location_num,note,location_num\n7,n,8\n")
    (tmp_path / "g.csv").write_bytes(b"PK\x03\x04\xff\xfe\x00junk\x00\x01")
    (tmp_path / "h.csv").write_text("location_num,flag\nnine,1\n10,yes,11\n")
    rejected = new_path(spark, "rejected")
    out = files.compact(
        spark,
        str(tmp_path),
        new_path(spark, "compact"),
        spark.createDataFrame([], "location_num int, flag int, note string").schema,
        "short",
        date(2001, 7, 1),
        rejected=rejected,
    )
    assert sorted(((r.location_num, r.flag, r.note) for r in out.collect()), key=repr) == sorted(
        [
            (1, 0, 'x, "y"'), (2, None, None), (3, 1, None), (4, None, None),
            (5, None, "two\nlines, quoted"), (6, None, "one"), (7, None, "n"),
            (None, 1, None), (10, None, None),
        ],
        key=repr,
    )
    bad = spark.read.schema(files.REJECTS).parquet(rejected).collect()
    assert sorted(((r.path[-5:], r.column_name, r.value, r.reason) for r in bad), key=repr) == sorted(
        [
            ("f.csv", "location_num", None, "repeated column"),
            ("g.csv", None, None, "no wanted column"),
            ("h.csv", "location_num", "nine", "not a int"),
            ("h.csv", "flag", "yes", "not a int"),
            ("h.csv", None, "11", "beyond the header"),
        ],
        key=repr,
    )


def test_compaction_of_no_usable_file(spark, tmp_path):
    (tmp_path / "d.csv").write_text("")
    schema = spark.createDataFrame([], "location_num int").schema
    rows, rejects = files.read_small_files(spark, str(tmp_path), schema)
    assert rows.count() == 0 and rejects.count() == 0


def test_latest_partition_falls_back(spark):
    empty = spark.createDataFrame([], "d date")
    assert files.latest_partition(empty, "d", date(2001, 7, 1)).first().d == date(2001, 7, 1)


def test_restore_only_without_exactly_one_snapshot(spark):
    schema = "pin int, generation_date date"
    history = spark.createDataFrame([(1, date(2001, 1, 1)), (2, date(2001, 2, 1))], schema)
    live = spark.createDataFrame([(9, date(2001, 3, 1))], schema)
    two = live.union(spark.createDataFrame([(8, date(2001, 2, 1))], schema))
    assert [r.pin for r in files.restore_if_needed(live, history).collect()] == [9]
    assert sorted(r.pin for r in files.restore_if_needed(two, history).collect()) == [2, 8, 9]


def test_unknown_verdicts_go_to_quarantine(spark):
    df = spark.createDataFrame([(1, "Success"), (2, "Failed"), (3, None)], "k int, status string")
    passed, held = files.route(df, new_path(spark, "routed"))
    assert [r.k for r in passed.collect()] == [1]
    assert sorted(r.k for r in held.collect()) == [2, 3]
    assert [part.count() for part in files.route(df.limit(0), new_path(spark, "routed"))] == [0, 0]


def test_a_row_whose_verdict_changes_is_routed_once(spark):
    rolled = spark.range(2000).select("id", F.when(F.rand() < 0.5, "Success").alias("status"))
    passed, held = files.route(rolled, new_path(spark, "routed"))
    ok, bad = ({r.id for r in part.collect()} for part in (passed, held))
    assert not ok & bad and ok | bad == set(range(2000)) and ok and bad


def one_document(spark, store, day, generated):
    forecast = schemas.DOCUMENT["Forecast"].dataType
    values = {f.name: None for f in forecast}
    values |= {"StoreNumber": store, "BusinessDay": f"{day}T00:00:00"}
    values |= {n: [] for n in ("MetricDetail", "SalesItemDetail", "InventoryItemDetail")}
    row = (tuple(values[f.name] for f in forecast), f"{generated}T00:00:00.000Z")
    return spark.createDataFrame([row], schemas.DOCUMENT)


def test_arrival_log_continues_after_a_restart(spark):
    source, out, mark = (new_path(spark, n) for n in ("docs", "log", "mark"))
    documents.write_documents(one_document(spark, "00001", "2001-07-18", "2001-07-01"), source)

    def run():
        return arrivals.stream_arrivals(spark, source, out, mark, "short", date(2001, 7, 1))

    assert run().count() == 1
    documents.write_documents(
        one_document(spark, "00002", "2001-07-18", "2001-07-01"), source, "append"
    )
    assert sorted(r.location_num for r in run().collect()) == ["00001", "00002"]
    assert run().count() == 2


def arrivals_of(spark, source, rows):
    """One delivery of (name, generated, hours after the start)."""
    start = datetime(2001, 7, 1)
    rows = [(n, g, start + timedelta(hours=h)) for n, g, h in rows]
    df = spark.createDataFrame(rows, "file_name string, generation_date string, arrived_at timestamp")
    df.coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(df.schema).parquet(source)


def kept(registry):
    start = datetime(2001, 7, 1)
    return sorted(
        (r.file_name, r.generation_date, *((t - start) / timedelta(hours=1) for t in r[2:5]))
        for r in registry.select("file_name", "generation_date", "first_at", "arrived_at", "expires_at").collect()
    )


def test_registry_renews_expires_and_starts_anew(spark):
    source, out, mark = (new_path(spark, n) for n in ("puts", "registry", "mark"))

    def put(*rows):
        return kept(arrivals.stream_entries(arrivals_of(spark, source, rows), out, mark))

    assert put(("a", "1", 0), ("b", "1", 1), ("b", "0", 0.5)) == [
        ("a", "1", 0, 0, 60), ("b", "1", 0.5, 1, 61),
    ]
    # a renewed before it expires, c new
    assert put(("a", "2", 40), ("c", "1", 50)) == [
        ("a", "2", 0, 40, 100), ("b", "1", 0.5, 1, 61), ("c", "1", 50, 50, 110),
    ]
    # the clock reaches b's expiry; the same file once more changes nothing; an old put loses
    assert put(("c", "1", 50), ("a", "0", 39), ("d", "1", 61)) == [
        ("a", "2", 0, 40, 100), ("c", "1", 50, 50, 110), ("d", "1", 61, 61, 121),
    ]
    # one hour before and at the expiry of a; b comes back as a new entry
    assert put(("b", "3", 99))[0] == ("a", "2", 0, 40, 100)
    assert put(("b", "4", 100)) == [("b", "4", 99, 100, 160), ("c", "1", 50, 50, 110), ("d", "1", 61, 61, 121)]
    assert put(("a", "9", 500)) == [("a", "9", 500, 500, 560)]
    assert kept(arrivals.registry(spark, out)) == [("a", "9", 500, 500, 560)]


def test_a_repeated_batch_gives_the_same_state_and_the_disk_stays_bounded(spark):
    source, out, mark = (new_path(spark, n) for n in ("puts", "registry", "mark"))
    folder = Path(out.removeprefix("file:"))
    for day in range(7):
        rows = [(f"{day}-{k}", "1", 24 * day) for k in range(400)]
        stream = arrivals_of(spark, source, rows)
        live = arrivals.stream_entries(stream, out, mark)
        assert live.count() == 400 * min(3, day + 1)  # those of the last 60 hours
        assert sorted(p.name for p in folder.iterdir() if p.name.startswith("slot")) == [
            f"slot={k}" for k in range(min(2, day + 1))
        ]
        stored = spark.read.schema(arrivals.REGISTRY).parquet(out).groupBy("batch").count().collect()
        assert all(r["count"] <= 400 * 4 for r in stored)
    # a driver that died after the last batch was written, before it was noted as done
    last = max(Path(mark.removeprefix("file:"), "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    before = kept(arrivals.registry(spark, out))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    assert kept(arrivals.stream_entries(stream, out, mark)) == before


def test_documents_register_by_their_change(spark):
    source, out, mark = (new_path(spark, n) for n in ("docs", "registry", "mark"))
    for generated in ("2001-07-01", "2001-07-02"):
        documents.write_documents(
            one_document(spark, "00001", "2001-07-18", generated), source, "append"
        )
        registry = arrivals.stream_registry(spark, source, out, mark)
    row = registry.collect()
    assert [(r.file_name, r.generation_date) for r in row] == [
        ("00001/demand-07-18-2001.json", "2001-07-02")
    ]
    assert (row[0].expires_at - row[0].arrived_at).total_seconds() == 60 * 3600
    assert arrivals.live_entries(registry, F.lit(row[0].expires_at)).count() == 0
