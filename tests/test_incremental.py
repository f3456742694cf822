"""Keyed deletes, upserts, marks and change logs against brute force in Python."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from transferkit import (
    ChangeLog, Endpoint, PlacedTable, delete_by_keys, delete_statements, high_water_mark, latest_per_key, read_stream,
    since, upsert,
)
from transferkit.operators import places


def random_rows(rng, n, keys=6):
    def key(choices):
        return None if rng.random() < 0.15 else rng.choice(choices)

    return [(key(range(keys)), key("abc"), rng.randint(0, 99)) for _ in range(n)]


SCHEMA = "k int, l string, v int"


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def brute_delete(target, keys):
    doomed = {k for k in keys if None not in k}
    return [r for r in target if r[:2] not in doomed]


@pytest.mark.parametrize("seed", range(4))
def test_delete_and_upsert(spark, seed):
    rng = random.Random(seed)
    target, rows = random_rows(rng, 80), random_rows(rng, 12)
    t, r = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(rows, SCHEMA)
    left = brute_delete(target, [x[:2] for x in rows])
    assert bag(delete_by_keys(t, r, ["k", "l"])) == sorted(left, key=repr)
    assert bag(upsert(t, r, ["k", "l"])) == sorted(left + rows, key=repr)


def test_delete_works_without_broadcast_and_with_odd_names(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.range(100).select(F.col("id").alias("a.b"), (F.col("id") % 7).alias("my col"))
        gone = spark.range(3).select(F.col("id").alias("my col"))
        assert delete_by_keys(t, gone, ["my col"]).count() == sum(i % 7 > 2 for i in range(100))
        gone = spark.range(3).select(F.col("id").alias("a.b"))
        assert delete_by_keys(t, gone, ["a.b"]).count() == 97
        assert upsert(t, t.where("`a.b` < 3"), ["a.b"]).count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_split(spark, folder):
    """A third of the target has one key; the join spreads it over several tasks."""
    hot = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("k"), F.lpad(F.col("id").cast("string"), 50, "x").alias("v")
    )
    keys = spark.range(0, 2_000, 1, 4).select(F.col("id").alias("k")).unionAll(spark.range(0, 9_000).select(F.lit(1999).alias("k")))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = delete_by_keys(hot, keys, ["k"])
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        changes = hot.withColumn("batch_id", (F.length("v") % 2).cast("int"))
        log = latest_per_key(changes, ["k"])
        kept = len(log.collect())
        log_plan = log._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(rows) == sum(1 for i in range(60_000) if i % 3 == 0 or i % 5000 >= 2_000)
    assert kept == 60_000
    assert "skew=true" in plan and "skew=true" in log_plan


def test_mark(spark):
    target = spark.createDataFrame([(1, 5), (2, 9)], "k int, m int")
    source = spark.createDataFrame([(3, 9), (4, 10), (5, None), (6, 8)], "k int, m int")
    assert [r.k for r in since(source, "m", target, inclusive=False).collect()] == [4]
    # at the mark, after it, and without one
    assert sorted(r.k for r in since(source, "m", target, inclusive=True).collect()) == [3, 4, 5]
    assert since(source, "m", target.where("false"), inclusive=True).count() == 4
    assert since(source, "m", target.withColumn("m", F.lit(None).cast("int")), inclusive=False).count() == 4
    assert high_water_mark(target, "m") == 9


def test_the_mark_reaches_the_file_scan(spark, folder):
    spark.range(1000).write.parquet(f"{folder}/s")
    source = spark.read.parquet(f"{folder}/s")
    df = since(source, "id", source.where("id < 500"), inclusive=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,499)]" in plan
    assert df.count() == 500
    df = since(source, "id", source.where("id < 500"), inclusive=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(id,499),IsNull(id))]" in plan
    assert df.count() == 501


def parse_tuples(statement):
    return re.findall(r"\((\d+),(null|'(?:[^']|'')*')\)", statement.split(" in (", 1)[1])


@pytest.mark.parametrize("buckets", [None, 5])
def test_delete_statements_name_every_key_once(spark, buckets):
    rng = random.Random(9)
    keys = [(rng.randint(0, 50), rng.choice(["a", "it's", None])) for _ in range(400)]
    df = spark.createDataFrame(keys, "k int, l string")
    out = delete_statements(df, "postgresql", "t", "s", buckets=buckets).collect()
    seen = [t for r in out for t in parse_tuples(r.statement)]
    wanted = {(str(k), "null" if v is None else "'" + v.replace("'", "''") + "'") for k, v in keys}
    assert len(seen) == len(set(seen)) and set(seen) == wanted
    sizes = [len(parse_tuples(r.statement)) for r in out]
    assert max(sizes) == 6 and sum(s < 6 for s in sizes) <= (buckets or 1)
    if buckets is None:
        assert {r.bucket for r in out} == {0} and sorted(r.batch for r in out) == list(range(len(out)))
    assert all(r.statement.startswith("delete from s.t where (k,l) in (") and r.statement.endswith(")") for r in out)


def test_delete_statements_of_sql_server(spark):
    df = spark.createDataFrame([(1, "a")], "k int, l string")
    assert delete_statements(df, "mssql", "t", "s").first().statement == "delete from s.t where (k = 1 and l = 'a')"
    assert delete_statements(df, "mssql", "t", "s", ["k"]).first().statement == "delete from s.t where k in (1)"
    assert delete_statements(df, "mssql", "t", "s", compat=True).first().statement == "delete from s.t where (k,l) in ((1,'a'))"


def brute_log(batches):
    state = []
    for rows in batches:
        state = brute_delete(state, [r[:2] for r in rows]) + rows
    return sorted(state, key=repr)


def test_change_log(spark, folder):
    rng = random.Random(21)
    log, done = ChangeLog(f"{folder}/log", ("k", "l")), []
    for n in range(4):
        rows = random_rows(rng, 30)
        done.append(rows)
        assert log.load(spark, spark.createDataFrame(rows, SCHEMA)) == n
        assert bag(log.current(spark)) == brute_log(done)
    log.write(spark.createDataFrame(done[3], SCHEMA), 3)  # the same batch again
    assert bag(log.current(spark)) == brute_log(done)
    assert bag(log.compact(spark, f"{folder}/small").current(spark)) == brute_log(done)


def test_an_uncommitted_batch_does_not_count(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k",))
    log.load(spark, spark.createDataFrame([(1, "a", 1)], SCHEMA))
    spark.createDataFrame([(1, "b", 2)], SCHEMA).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{folder}/log/batch_id=1")
    assert bag(log.current(spark)) == [(1, "a", 1)]
    assert log.load(spark, spark.createDataFrame([(1, "c", 3)], SCHEMA)) == 1
    assert bag(log.current(spark)) == [(1, "c", 3)]


def test_marks_are_kept_beside_the_log(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k",))
    rows = spark.createDataFrame([(n, "x", n) for n in range(10)], SCHEMA)
    log.load(spark, rows.where("v < 4"), "v")
    assert log.high_water_mark(spark, "v") == 3
    log.load(spark, rows, "v")
    assert log.high_water_mark(spark, "v") == 9
    assert log.read(spark, [1]).count() == 7  # the row at the mark again
    log.load(spark, rows.withColumn("v", F.lit(50)).where("k = 2"))  # no mark kept for this one
    assert log.high_water_mark(spark, "v") == 50
    log.load(spark, rows, "v")  # nothing newer
    assert log.high_water_mark(spark, "v") == 50
    assert log.current(spark).count() == 10


def test_stream_of_changes(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k", "l"))
    first = [(1, "a", 1), (2, None, 2), (3, "c", 3)]
    log.load(spark, spark.createDataFrame(first, SCHEMA))
    source = Endpoint("mysql", path=f"{folder}/in")
    done, checkpoint = [first], f"{folder}/cp"
    for rows in ([(1, "a", 10), (4, "d", 4)], [(1, "a", 11), (2, None, 20)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in/changes")
        log.follow(read_stream(spark, source, "changes"), checkpoint)
        done.append(rows)
        assert bag(log.current(spark)) == brute_log(done)
    assert log.batches(spark) == [0, 1, 2]
    log.follow(read_stream(spark, source, "changes"), checkpoint)  # nothing new
    assert bag(log.current(spark)) == brute_log(done)


def test_loads_and_streams_take_turns(spark, folder):
    """No batch number is given twice, also not to a stream that starts late or runs an epoch again."""
    log = ChangeLog(f"{folder}/log", ("k", "l"))
    done = [[(n, "a", n)] for n in range(3)]
    for rows in done:
        log.load(spark, spark.createDataFrame(rows, SCHEMA))
    source = Endpoint("mysql", path=f"{folder}/in")
    for n in (3, 5):
        spark.createDataFrame([(n, "s", n)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in/changes")
        log.follow(read_stream(spark, source, "changes"), f"{folder}/cp")
        log.load(spark, spark.createDataFrame([(n + 1, "b", n)], SCHEMA))
        done += [[(n, "s", n)], [(n + 1, "b", n)]]
    assert log.batches(spark) == list(range(7))
    assert bag(log.current(spark)) == brute_log(done)
    assert sorted(log._epochs(spark).values()) == [3, 5]


def test_no_success_file_is_needed(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k",))
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        assert [log.load(spark, spark.createDataFrame([(n, "a", n)], SCHEMA)) for n in range(3)] == [0, 1, 2]
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert bag(log.current(spark)) == [(n, "a", n) for n in range(3)]


def test_a_cut_off_attempt_is_never_written_over(spark, folder, monkeypatch):
    import transferkit.streaming.changes as changes

    log, make = ChangeLog(f"{folder}/log", ("k",)), changes.make_folder
    log.load(spark, spark.createDataFrame([(1, "a", 1)], SCHEMA))

    def cut(spark, path):
        if "/_commits/" in path:
            raise OSError("cut off")
        make(spark, path)

    monkeypatch.setattr(changes, "make_folder", cut)
    with pytest.raises(OSError):
        log.load(spark, spark.createDataFrame([(1, "lost", 2)], SCHEMA))
    monkeypatch.setattr(changes, "make_folder", make)
    assert bag(log.current(spark)) == [(1, "a", 1)]
    assert log.load(spark, spark.createDataFrame([(1, "c", 3)], SCHEMA)) == 2
    assert bag(log.current(spark)) == [(1, "c", 3)] and log.batches(spark) == [0, 2]


def test_columns_of_the_log(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k",))
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    log.load(spark, rows)
    log.load(spark, rows.where("k = 2").withColumn("more", F.lit(9)))
    assert bag(log.current(spark)) == [(1, "a", 1, None), (2, "b", 2, 9)]
    for wrong in (rows, rows.withColumn("more", F.lit("text"))):
        with pytest.raises(ValueError, match="more"):
            log.load(spark, wrong)
    assert log.batches(spark) == [0, 1]


def test_the_first_batch_is_not_grouped(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k",))
    for n in range(3):
        log.load(spark, spark.createDataFrame([(n, "a", n), (0, "b", n)], SCHEMA))
    plan = log.current(spark)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*batch_id#\d+ > 0", plan)


def test_rows_without_a_mark(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k",))
    log.load(spark, spark.createDataFrame([(1, "a", 7)], SCHEMA), "v")
    log.load(spark, spark.createDataFrame([(1, "a", 7), (2, "b", None)], SCHEMA), "v")
    assert bag(log.current(spark)) == [(1, "a", 7), (2, "b", None)]


def test_rows_that_share_the_newest_mark(spark, folder):
    log = ChangeLog(f"{folder}/log", ("k",))
    log.load(spark, spark.createDataFrame([(1, "a", 7)], SCHEMA), "v")
    later = spark.createDataFrame([(1, "a", 7), (2, "b", 7)], SCHEMA)
    log.load(spark, later, "v")
    assert bag(log.current(spark)) == [(1, "a", 7), (2, "b", 7)]


def test_a_known_mark_is_pushed_to_the_source(spark, folder):
    from transferkit.operators.incremental import after

    spark.range(10).select(F.col("id").cast("int").alias("id")).write.parquet(f"{folder}/s")
    df = after(spark.read.parquet(f"{folder}/s"), "id", 4, inclusive=False)
    assert "GreaterThan(id,4)" in df._jdf.queryExecution().executedPlan().toString()
    assert after(spark.range(3), "id", None).count() == 3


ZONES = ["Asia/Tokyo", "America/Los_Angeles"]


@pytest.fixture(params=ZONES)
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def hours(spark, kind):
    """48 rows an hour apart, over the hours that summer time takes and gives in Los Angeles."""
    first = "timestamp_ntz '2024-03-09 20:00:00.000001'"
    rows = spark.sql(f"select id, {first} + make_dt_interval(0, id * 5) as at from range(48) union all "
                     f"select id + 48, timestamp_ntz '2024-11-02 20:00:00.5' + make_dt_interval(0, id) from range(24)")  # fmt: skip
    if kind == "timestamp":
        rows = rows.withColumn("at", F.concat(F.col("at").cast("string"), F.lit("Z")).cast("timestamp"))
    elif kind == "date":
        rows = rows.withColumn("at", F.col("at").cast("date"))
    return rows


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_marks_do_not_depend_on_zones(spark, folder, zone, kind):
    rows = hours(spark, kind)
    rows.write.parquet(f"{folder}/all")
    rows = spark.read.parquet(f"{folder}/all")
    for known in (6, 55):
        target = rows.where(F.col("id") < known)
        edge = {r.id for r in rows.where(F.col("at") == F.lit(rows.where(F.col("id") == known - 1).select("at").scalar())).collect()}
        assert {r.id for r in since(rows, "at", target, inclusive=True).collect()} == set(range(known, 72)) | edge
        assert {r.id for r in since(rows, "at", target, inclusive=False).collect()} == set(range(known, 72)) - edge


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_no_load_loses_rows_in_any_zone(spark, folder, zone, kind):
    rows = hours(spark, kind)
    log = ChangeLog(f"{folder}/log", ("id",))
    for known, inclusive in ((6, True), (30, False), (55, True), (72, False)):
        log.load(spark, rows.where(F.col("id") < known), "at", inclusive)
    assert sorted(r.id for r in log.current(spark).collect()) == list(range(72))
    assert [log.read(spark, [b]).count() for b in log.batches(spark)] == [6, 24, 26, 17]


def test_incremental_transfers_in_any_zone(spark, folder, zone):
    from transferkit import incremental_transfer, write_table

    rows = hours(spark, "timestamp_ntz")
    source, target = Endpoint("mysql", path=f"{folder}/source"), Endpoint("postgresql", path=f"{folder}/target")
    for low, high in ((0, 6), (6, 40), (40, 72)):
        write_table(rows.where(F.col("id").between(low, high - 1)), source, "t", create_table=True)
        moved = incremental_transfer(spark, source, target, "t", ["id"], "at")
        assert sorted(map(tuple, moved.collect())) == sorted(map(tuple, rows.where(F.col("id") < high).collect()))


def test_marks_across_kinds_of_time(spark, zone):
    """A target that keeps instants as UTC times without zone."""
    rows = hours(spark, "timestamp")
    target = hours(spark, "timestamp_ntz").where("id < 30")
    assert {r.id for r in since(rows, "at", target, inclusive=False).collect()} == set(range(30, 72))
    for known in (55, 61, 62, 63):  # an hour comes twice in Los Angeles
        later = since(hours(spark, "timestamp_ntz"), "at", rows.where(F.col("id") < known), inclusive=False)
        assert {r.id for r in later.collect()} == set(range(known, 72))
    before = rows.where("id < 1").select(F.expr("timestamp '1955-11-05 06:15:00.000007Z' as at"), "id")
    assert since(hours(spark, "timestamp_ntz"), "at", before, inclusive=True).count() == 72


def test_tiers(spark, folder):
    """Merged in place after every load, the log reads as its batches do; a plan made before goes on."""
    rng = random.Random(33)
    log, done = ChangeLog(f"{folder}/log", ("k", "l")), []
    for n in range(8):
        rows = random_rows(rng, 30 if n else 200, keys=12)
        done.append(rows)
        log.load(spark, spark.createDataFrame(rows, SCHEMA))
        before = log.current(spark)
        if log.tidy(spark, fanout=2):
            assert bag(before) == bag(log.current(spark)) == brute_log(done)
    runs = [(r.first, r.last) for r in log._runs(spark)]
    assert runs == [(0, 0), (1, 4), (5, 6), (7, 7)] and log.batches(spark) == list(range(8))
    assert log.vacuum(spark) > 6 and log.vacuum(spark) == 0
    assert bag(log.current(spark)) == brute_log(done)
    with pytest.raises(ValueError, match="merged with others"):
        log.write(spark.createDataFrame(done[3], SCHEMA), 3)
    with pytest.raises(ValueError, match="whole runs"):
        log.merge(spark, 3, 6)
    done.append(random_rows(rng, 9, keys=12))
    assert log.load(spark, spark.createDataFrame(done[-1], SCHEMA)) == 8
    assert bag(log.current(spark)) == brute_log(done)


def test_a_merge_that_was_cut_off_does_not_count(spark, folder, monkeypatch):
    from transferkit.streaming import changes

    log = ChangeLog(f"{folder}/log", ("k",))
    for n in range(3):
        log.load(spark, spark.createDataFrame([(n, "a", n), (7, "b", n)], SCHEMA))
    with monkeypatch.context() as m:
        m.setattr(changes, "make_folder", lambda *a: (_ for _ in ()).throw(IOError("gone")))
        with pytest.raises(IOError):
            log.merge(spark, 1, 2)
    expected = [(0, "a", 0), (1, "a", 1), (2, "a", 2), (7, "b", 2)]
    assert len(log._runs(spark)) == 3 and bag(log.current(spark)) == expected
    log.merge(spark, 1, 2)
    assert log.vacuum(spark) == 6 and bag(log.current(spark)) == expected


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batches_that_share_no_key_are_not_joined(spark, folder):
    log = ChangeLog(f"{folder}/log", ("id",))
    for low in (0, 1000, 2000):
        log.load(spark, spark.range(low, low + 1000))
    current = log.current(spark)
    assert "Join" not in plan_of(current) and "Exchange" not in plan_of(current) and current.count() == 3000
    log.load(spark, spark.range(1500, 1600))  # only the second batch is looked up
    current = log.current(spark)
    assert plan_of(current).count("batch_id=0") <= 1 and current.count() == 3000


def test_the_oldest_batch_is_not_exchanged(spark, folder):
    log = ChangeLog(f"{folder}/log", ("id",))
    log.load(spark, spark.range(0, 50_000).select("id", F.lit("old").alias("v")))
    log.load(spark, spark.range(0, 50_000, 500).select("id", F.lit("new").alias("v")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        current = log.current(spark)
        plan = plan_of(current)
        exchanged = current.select("id").where("v = 'old'")
        assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
        assert exchanged.count() == 49_900 and current.where("v = 'new'").count() == 100
        # what goes to the exchange are the rows of a hundred cells
        touched = spark.read.parquet(f"{log.path}/_keys/1.0/cells").count()
        assert touched <= 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_merged_streams_are_not_written_again(spark, folder):
    source = Endpoint("postgresql", path=f"{folder}/in")
    spark.range(10).withColumn("v", F.lit("a")).write.parquet(f"{folder}/in/t")
    log = ChangeLog(f"{folder}/log", ("id",))
    log.load(spark, spark.range(3).withColumn("v", F.lit("first")))
    for n in range(3):
        log.follow(read_stream(spark, source, "t"), f"{folder}/checkpoint")
        spark.range(n, n + 2).withColumn("v", F.lit(f"b{n}")).write.mode("append").parquet(f"{folder}/in/t")
    log.tidy(spark, fanout=2)
    rows = bag(log.current(spark))
    # the last epoch's end was not noted
    last = max(int(x) for x in os.listdir(f"{folder}/checkpoint/commits") if x.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    log.follow(read_stream(spark, source, "t"), f"{folder}/checkpoint")
    found = bag(log.current(spark))
    assert {k for k, _ in found} == {k for k, _ in rows} == set(range(10))


def placed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/t")
    return PlacedTable(f"{folder}/t")


@pytest.mark.parametrize("named", [0, 1000])
def test_deletes_by_place(spark, folder, monkeypatch, named):
    monkeypatch.setattr(places, "NAMED_FILES", named)
    rng = random.Random(17)
    state = random_rows(rng, 300, keys=40)
    table = placed(spark, folder, state)
    assert bag(table.read(spark)) == sorted(state, key=repr)
    for n in range(6):
        rows = random_rows(rng, 15, keys=40)
        df = spark.createDataFrame(rows, SCHEMA)
        state = brute_delete(state, [r[:2] for r in rows])
        if n % 2:
            table.upsert(spark, df, ["k", "l"])
            state = state + rows
        else:
            table.delete(spark, df, ["k", "l"])
        assert bag(table.read(spark)) == sorted(state, key=repr)
        if n == 3:
            assert table.rewrite(spark, 0.1) > 0
            assert bag(table.read(spark)) == sorted(state, key=repr)
        if n == 4:
            assert table.vacuum(spark) > 0 and table.vacuum(spark) == 0
            assert bag(table.read(spark)) == sorted(state, key=repr)


def data_files_of(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")
            and "/_deletes/" not in d and "/_replaced/" not in d}


def test_only_touched_files_are_rewritten(spark, folder):
    spark.range(0, 8000, 1, 8).write.parquet(f"{folder}/t")
    table, before = PlacedTable(f"{folder}/t"), data_files_of(folder)
    table.delete(spark, spark.range(0, 600), ["id"])  # most of the first file
    table.delete(spark, spark.range(3000, 3010), ["id"])  # a few rows of the fourth
    assert data_files_of(folder) == before
    plan = plan_of(table.read(spark))
    assert plan.count("Join") == 1 and "Union" in plan  # files without deletes are read without one
    assert table.rewrite(spark, 0.5) == 1
    after = data_files_of(folder)
    assert before.items() <= after.items() and len(after) == 9 and table.read(spark).count() == 8000 - 610
    table.vacuum(spark)
    left = data_files_of(folder)
    assert len(left) == 8 and len(before.keys() & left.keys()) == 7
    assert {r.id for r in table.read(spark).collect()} == set(range(600, 8000)) - set(range(3000, 3010))


def test_a_cut_off_change_does_not_count(spark, folder, monkeypatch):
    table = placed(spark, folder, [(1, "a", 1), (2, "b", 2)])
    with monkeypatch.context() as m:
        m.setattr(places, "make_folder", lambda *a: (_ for _ in ()).throw(IOError("gone")))
        for change in (lambda: table.delete(spark, spark.createDataFrame([(1,)], "k int"), ["k"]),
                       lambda: table.upsert(spark, spark.createDataFrame([(2, "c", 3)], SCHEMA), ["k"])):
            with pytest.raises(IOError):
                change()
    assert bag(table.read(spark)) == [(1, "a", 1), (2, "b", 2)]
    assert table.vacuum(spark) == 4
    table.upsert(spark, spark.createDataFrame([(2, "c", 3)], SCHEMA), ["k"])
    assert bag(table.read(spark)) == [(1, "a", 1), (2, "c", 3)]


@pytest.mark.parametrize("rows", [0, 1, 400])
def test_numbers_in_order(spark, rows):
    from transferkit.operators.numbering import numbered

    rng = random.Random(rows)
    data = [(rng.choice([None, "a", "b", "é"]), rng.randrange(50), n) for n in range(rows)]
    df = spark.createDataFrame(data, "s string, number int, v int").repartition(3)
    found = numbered(df, ["s", "number"], "n").collect()
    order = sorted(found, key=lambda r: r.n)
    assert [r.n for r in order] == list(range(rows)) and sorted(r.v for r in found) == list(range(rows))
    assert [(r.s is not None, r.s or "", r.number) for r in order] == sorted((s is not None, s or "", k) for s, k, _ in data)
