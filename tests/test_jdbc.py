"""JDBC settings and statements.  No database is started, so what is checked is what would be sent."""

import random
import re
import threading

import duckdb
import pytest
from pyspark.sql import functions as F

from transferkit import SYSTEMS, ColumnInfo, Endpoint, tag
from transferkit.sinks import ledger
from transferkit.sinks import tables as sink
from transferkit.sources import jdbc, metadata, splits
from transferkit.sources.endpoint import Partitioning, hash_predicates

URLS = {
    "postgresql": "jdbc:postgresql://h/d",
    "mssql": "jdbc:sqlserver://h;databaseName=d",
    "mysql": "jdbc:mysql://h/d",
    "oracle": "jdbc:oracle:thin:@h:1521/d",
    "snowflake": "jdbc:snowflake://a.snowflakecomputing.com/?db=d",
}


@pytest.mark.parametrize("system", list(SYSTEMS))
def test_read_options(system):
    source = Endpoint(system, url=URLS[system], options={"user": "u", "fetchsize": "5000"})
    got = jdbc.table_options(source, "s.t", Partitioning("id", 1, 900, 8))
    assert got["url"] == URLS[system] and got["driver"] == SYSTEMS[system].driver
    assert (got["dbtable"], got["partitionColumn"], got["lowerBound"], got["numPartitions"]) == ("s.t", "id", "1", "8")
    assert got["preferTimestampNTZ"] == "true" and got["user"] == "u"
    query = jdbc.query_options(source, " select 1; ")
    assert query["query"] == "select 1" and "dbtable" not in query
    parted = jdbc.query_options(source, "select * from t;", Partitioning("id", 1, 900, 8))
    assert parted["dbtable"] == "(select * from t) q" and "query" not in parted


def test_bad_endpoints():
    with pytest.raises(ValueError, match="JDBC url"):
        Endpoint("mysql", url="mysql://h/d")
    with pytest.raises(ValueError, match="not both"):
        Endpoint("mysql", url=URLS["mysql"], path="/x")


def test_hash_predicates_are_disjoint_and_complete(spark):
    df = spark.range(-50, 50).select("id").unionAll(spark.sql("select cast(null as bigint) as id"))
    for system in ("postgresql", "mssql"):
        parts = hash_predicates("id", 4, system)
        counts = [df.where(p).count() for p in parts]
        assert len(parts) == 5 and sum(counts) == 101 and counts[-1] == 1


@pytest.mark.parametrize("system", list(SYSTEMS))
def test_catalog_queries_quote_names(system):
    query = jdbc.columns_query(system, "o'brien", ["it's"])
    assert "'o''brien'" in query.lower() and "'it''s'" in query.lower()
    keys = jdbc.keys_query(system, "s", ["t"])
    assert (keys is None) == (system == "snowflake")


def test_mysql_catalog_is_filtered_by_schema_and_sign():
    query = jdbc.columns_query("mysql", "shop", ["t"])
    assert "table_schema = 'shop'" in query and "unsigned" in query
    assert "database()" in jdbc.columns_query("mysql", None)


def test_oracle_names_are_upper():
    assert "owner = 'SALES' and table_name in ('T')" in jdbc.columns_query("oracle", "sales", ["t"])


def test_schema_and_drop_statements():
    assert sink.schema_statement("postgresql", "s") == "create schema if not exists s"
    assert sink.schema_statement("mssql", "my s") == "if schema_id('my s') is null exec('create schema [my s]')"
    assert sink.schema_statement("mysql", "s") == "create database if not exists `s`"
    assert sink.schema_statement("oracle", "s") is None
    assert sink.drop_statement("snowflake", "s", "order") == 'drop table if exists s."order"'
    assert "sqlcode != -942" in sink.drop_statement("oracle", "s", "t")


def load_of(system, keys=(), columns=None):
    columns = columns or [ColumnInfo("id", "int64"), ColumnInfo("order", "json")]
    return ledger.Load("l'1", system, "t", "s", columns, tuple(keys))


def test_moving_a_part():
    load = load_of("postgresql")
    assert load.staging.startswith("s.tk_")
    assert load.move(3, 17) == [
        "insert into s.transferkit_ledger (load_id, part_no, try_id) values ('l''1', 3, 17)",
        f'insert into s.t select s.id, s."order" from {load.staging} s '
        "where s.transferkit_part = 3 and s.transferkit_try = 17",
    ]
    assert load_of("oracle").move(0, 1)[1].startswith('insert into s.t (id, "order") select s.id, s."order"')
    assert 'parse_json(s."order") from' in load_of("snowflake").move(0, 1)[1]
    assert load_of("snowflake").index() == [] and load.index()[0].startswith("create index tk_")
    replaced = load_of("mssql", ["id", "k 2"]).delete_replaced()
    assert replaced.startswith("delete from s.t where exists (select 1 from s.tk_")
    assert replaced.endswith(" s where s.id = t.id and s.[k 2] = t.[k 2])")


class Target:
    """Runs what would be sent to a database, one transaction after the other, and fails where it is told to."""

    def __init__(self, rows="id bigint, v text"):
        self.db = duckdb.connect()
        self.db.execute("create schema s")
        if rows:
            self.db.execute(f"create table s.t ({rows})")
        self.sent, self.fail, self.lost = [], None, None
        self.lock = threading.Lock()

    def run(self, spark, target, statements):
        with self.lock:
            self.sent.append(list(statements))
            if self.fail and any(self.fail in x for x in statements):
                raise ConnectionError("gone")
            self.db.execute("begin")
            try:
                for x in statements:
                    self.db.execute(x)
            except Exception:
                self.db.execute("rollback")
                raise
            self.db.execute("commit")
            if self.lost and any(self.lost in x for x in statements):
                raise ConnectionError("the answer to commit was lost")

    def rows(self, text):
        return sorted(self.db.execute(text).fetchall(), key=repr)

    def moves(self):
        return [x for x in self.sent if any("insert into s.t select" in y for y in x)]


@pytest.fixture
def loading(spark, monkeypatch):
    """A target, and rows written by tasks of which every other one runs twice."""

    def made(rows="id bigint, v text"):
        target = Target(rows)
        monkeypatch.setattr(sink, "run_statements", target.run)

        class Answer:
            def __init__(self, text):
                self.text = text

            def collect(self):
                return target.rows(self.text)

        monkeypatch.setattr(sink.jdbc, "load", lambda spark, options: Answer(options["query"]))

        class Writer:
            def __init__(self, df):
                self.df, self.opts = df, {}

            def format(self, name):
                return self

            def options(self, **kw):
                self.opts.update(kw)
                return self

            def mode(self, m):
                return self

            def save(self):
                for again in (False, True):
                    found = self.df.collect()
                    if again:
                        found = [r for r in found if r[ledger.PART] % 2]
                    mark = ", ".join("?" for _ in self.df.columns)
                    if found:
                        target.db.executemany(f"insert into {self.opts['dbtable']} values ({mark})", [tuple(r) for r in found])

        monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: Writer(self)))
        return target

    return made


POSTGRES = Endpoint("postgresql", url=URLS["postgresql"])
ROWS = [(i, None if i % 7 == 0 else f"v{i % 5}") for i in range(40)] + [(1, "v1")] * 3


def some_rows(spark, rows=None):
    return spark.createDataFrame(rows or ROWS, "id long, v string").repartition(6)


def test_a_load_moves_every_row_once(spark, loading):
    target = loading()
    sink.write_table(some_rows(spark), POSTGRES, "t", "s")
    assert target.rows("select * from s.t") == sorted(ROWS, key=repr)
    # every part in a transaction of its own, and nothing left of the staged rows
    assert len(target.moves()) == 6 and all(len(x) == 2 for x in target.moves())
    assert target.rows("select table_name from information_schema.tables") == [("t",), ("transferkit_ledger",)]
    assert len(target.rows("select * from s.transferkit_ledger")) == 1


def test_a_killed_load_goes_on(spark, loading):
    target = loading()
    target.fail = "transferkit_part = 3"
    with pytest.raises(RuntimeError, match="load_id='night'"):
        sink.write_table(some_rows(spark), POSTGRES, "t", "s", load_id="night")
    before = len(target.rows("select * from s.t"))
    assert 0 < before < len(ROWS)
    # the next run loses the answer to a commit
    target.fail, target.lost = None, "transferkit_part = 3"
    with pytest.raises(RuntimeError, match="load_id='night'"):
        sink.write_table(some_rows(spark), POSTGRES, "t", "s", load_id="night")
    target.lost = None
    sink.write_table(some_rows(spark), POSTGRES, "t", "s", load_id="night")
    assert target.rows("select * from s.t") == sorted(ROWS, key=repr)
    sink.write_table(some_rows(spark), POSTGRES, "t", "s", load_id="night")  # it is done: nothing happens
    assert target.rows("select * from s.t") == sorted(ROWS, key=repr)
    sink.write_table(some_rows(spark), POSTGRES, "t", "s", load_id="morning")
    assert len(target.rows("select * from s.t")) == 2 * len(ROWS)


def test_a_load_that_fails_while_it_stages_starts_anew(spark, loading):
    target = loading(rows=None)
    target.fail = "create index"
    with pytest.raises(ConnectionError):
        sink.write_table(some_rows(spark), POSTGRES, "t", "s", create_table=True, load_id="a")
    target.fail = None
    sink.write_table(some_rows(spark), POSTGRES, "t", "s", create_table=True, drop_table=True, load_id="a")
    assert target.rows("select * from s.t") == sorted(ROWS, key=repr)


def test_a_resumed_load_does_not_drop_what_has_moved(spark, loading):
    target = loading()
    target.db.execute("insert into s.t values (-1, 'old')")
    target.fail = "transferkit_part = 5"
    with pytest.raises(RuntimeError):
        sink.write_table(some_rows(spark), POSTGRES, "t", "s", create_table=True, drop_table=True, load_id="a")
    target.fail = None
    sink.write_table(some_rows(spark), POSTGRES, "t", "s", create_table=True, drop_table=True, load_id="a")
    assert target.rows("select * from s.t") == sorted(ROWS, key=repr)


@pytest.mark.parametrize("fail", [None, "delete from s.t", "insert into s.t select"])
def test_replacing_by_key_is_one_transaction(spark, loading, fail):
    target = loading()
    old = [(1, "old"), (2, "old"), (99, "old"), (None, "old")]
    target.db.executemany("insert into s.t values (?, ?)", old)
    target.fail = fail
    if fail:
        with pytest.raises(RuntimeError):
            sink.write_table(some_rows(spark), POSTGRES, "t", "s", keys=["id"], load_id="a")
        assert target.rows("select * from s.t") == sorted(old, key=repr)
        target.fail = None
    sink.write_table(some_rows(spark), POSTGRES, "t", "s", keys=["id"], load_id="a")
    assert target.rows("select * from s.t") == sorted([*ROWS, (99, "old"), (None, "old")], key=repr)
    assert len(target.moves()) == 1 + (fail is not None)


def test_order_of_a_jdbc_load(spark, loading):
    """Schema, ledger, drop, create, staging and moves, in that order and each once."""
    target = loading(rows=None)
    df = spark.createDataFrame([(1, "x")], "id int, v string").coalesce(1)
    sink.write_table(df, POSTGRES, "t", "s", create_schema=True, create_table=True, drop_table=True)
    staging = next(x[0] for x in target.sent if x[0].startswith("create table if not exists s.tk_")).split()[5]
    assert len(staging) == len("s.") + 30
    assert [x[0] for x in target.sent] == [
        "create schema if not exists s",
        "drop table if exists s.t",
        f"drop table if exists {staging}",
        f"create table if not exists {staging} (id integer, v text, transferkit_part integer, transferkit_try bigint)",
        f"create index {staging[2:-1]}i on {staging} (transferkit_part, transferkit_try)",
        target.sent[5][0],
        target.sent[6][0],
        target.sent[7][0],
        f"drop table if exists {staging}",
    ]
    assert target.sent[0][1] == (
        "create table if not exists s.transferkit_ledger "
        "(load_id text, part_no integer, try_id bigint, primary key (load_id,part_no))"
    )
    assert target.sent[1][1] == "create table if not exists s.t (id integer, v text)"
    assert ", -1, 0)" in target.sent[5][0] and "insert into s.t select" in target.sent[6][1]
    with pytest.raises(ValueError, match="need a schema"):
        sink.write_table(df, POSTGRES, "t")
    with pytest.raises(ValueError, match="load_id needs"):
        sink.write_table(df, POSTGRES, "t", "s", exactly_once=False, load_id="a")


def test_ledgers_have_keys_everywhere(spark):
    made = {s: ledger.ledger_statement(spark, s, "s") for s in SYSTEMS}
    assert "(`load_id` varchar(64), `part_no` integer, `try_id` bigint, primary key (`load_id`,`part_no`))" in made["mysql"]
    assert "load_id nvarchar(128)" in made["mssql"] and "load_id varchar2(256)" in made["oracle"]
    assert all("primary key" in x for x in made.values())


def test_attempts_are_the_tasks(spark):
    rows = ledger.with_attempt(some_rows(spark)).collect()
    tries = {(r[ledger.PART], r[ledger.TRY]) for r in rows}
    assert len(tries) == len({p for p, _ in tries}) == len({t for _, t in tries}) == 6
    plan = ledger.with_attempt(some_rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "attempt(SPARK_PARTITION_ID())" in plan


def test_uuids_are_bytes_where_the_column_is(spark):
    text = "0f0e0d0c-0b0a-0908-0706-050403020100"
    df = tag(spark.createDataFrame([(text,)], "u string"), {"u": "uuid"})
    assert sink.for_jdbc(df, "postgresql").first().u == text
    for target in ("mysql", "oracle", "snowflake"):
        assert bytes(sink.for_jdbc(df, target).first().u).hex() == text.replace("-", "")


def test_wide_numbers_and_times_are_read_as_text():
    cols = [
        ColumnInfo("a", "decimal", 10, 2), ColumnInfo("b", "decimal"), ColumnInfo("c", "decimal", 60, 2),
        ColumnInfo("d", "time"), ColumnInfo("e", "int64"),
    ]
    assert jdbc.custom_schema(cols) == {"customSchema": "`b` STRING, `c` STRING, `d` STRING"}
    assert jdbc.custom_schema(cols[:1]) == {}


def test_cursor_reads():
    for system, url in URLS.items():
        assert Endpoint(system, url=url).read_options()["fetchsize"] == "10000"
    assert Endpoint("mysql", url=URLS["mysql"]).read_options()["useCursorFetch"] == "true"


def test_hash_reads_send_their_predicates(spark, monkeypatch):
    from transferkit import read_table

    sent = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            sent.update(url=url, table=table, predicates=predicates, **properties)
            return spark.range(1)

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    source = Endpoint("oracle", url=URLS["oracle"])
    read_table(spark, source, "t", "s", key="my id", partitions=2, by_hash=True, infos=[ColumnInfo("id", "decimal")])
    assert sent["predicates"] == ['abs(mod("my id", 2)) = 0', 'abs(mod("my id", 2)) = 1', '"my id" is null']
    assert sent["customSchema"] == "`id` STRING" and sent["table"] == "s.t"
    with pytest.raises(ValueError, match="by_hash needs"):
        read_table(spark, source, "t", "s", by_hash=True)


def test_staging_tables_are_never_the_target_nor_shared():
    long = "t" * 63
    names = {ledger.staging_name("s", long, f"{n}") for n in range(3)} | {ledger.staging_name("s", long[:-1], "0")}
    assert len(names) == 4 and all(len(n) == 30 and n != long for n in names)


def test_connections_are_the_callers():
    target = Endpoint("postgresql", url=URLS["postgresql"])
    assert "numPartitions" not in sink.write_jdbc_options(target, "t")
    assert sink.write_jdbc_options(target, "t", 3)["numPartitions"] == "3"


def test_bounds_of_every_kind_of_key():
    import datetime
    from decimal import Decimal

    from transferkit.sources.jdbc import whole_bounds

    low, high = Decimal("1.0000000000"), Decimal("99.5")
    assert whole_bounds("k", low, high, 4).options()["lowerBound"] == "1"
    assert whole_bounds("k", low, high, 4).options()["upperBound"] == "100"
    day = datetime.date(2024, 1, 2)
    assert whole_bounds("k", day, day, 4).options()["lowerBound"] == "2024-01-02"
    assert whole_bounds("k", None, None, 4).options()["upperBound"] == "1"
    assert whole_bounds("k", Decimal(10) ** 30, Decimal(10) ** 31, 4).options()["upperBound"] == str(2**63 - 1)


def test_a_table_that_would_cut_values_is_not_made(spark, monkeypatch):
    monkeypatch.setattr(sink.catalog, "is_lossy", lambda *a: F.lit(True))
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="could cut values"):
        sink._statement_for(df, "mssql", "s", "t", False, False, False)
    assert sink._statement_for(df, "mssql", "s", "t", False, False, True)


def test_a_table_with_a_key_is_read_in_parallel(spark, monkeypatch):
    import importlib

    plans = importlib.import_module("transferkit.plans.transfer")

    seen = {}
    infos = [ColumnInfo("name", "nvarchar", primary_key=True), ColumnInfo("big", "decimal", primary_key=True),
             ColumnInfo("id", "uuid", primary_key=True), ColumnInfo("v", "int32")]
    monkeypatch.setattr(plans, "columns", lambda *a: None)
    monkeypatch.setattr(plans.catalog, "require_columns", lambda found, *a: found)
    monkeypatch.setattr(plans.catalog, "with_canonical_types", lambda found, *a: found)
    monkeypatch.setattr(plans.catalog, "infos_from_rows", lambda known: infos)
    monkeypatch.setattr(plans, "read_table", lambda *a, **kw: seen.update(kw, given=a[4:]))
    source = Endpoint("postgresql", url=URLS["postgresql"])
    plans.read_source(spark, source, "t", "s")
    assert seen["key"] == ["name", "big", "id"] and seen["partitions"] == max(2, spark.sparkContext.defaultParallelism)
    plans.read_source(spark, source, "t", "s", key="v", partitions=5, by_hash=True)
    assert (seen["key"], seen["partitions"], seen["by_hash"]) == ("v", 5, True)
    seen.clear()
    given = Partitioning("id", 0, 9, 3)
    plans.read_source(spark, source, "t", "s", partition=given)
    assert seen["given"] == (given,) and "key" not in seen
    infos[:] = [ColumnInfo("flag", "bool", primary_key=True), *infos[2:]]  # nothing to cut along
    seen.clear()
    plans.read_source(spark, source, "t", "s")
    assert "key" not in seen and seen["given"] == (None,)


class Source:
    """A table in place of a database's, asked in the database's words."""

    def __init__(self, spark, rows, kinds):
        self.spark = spark
        self.db = duckdb.connect()
        self.db.execute(f"create table t ({kinds})")
        self.db.executemany(f"insert into t values ({', '.join('?' for _ in rows[0])})", rows)
        self.rows, self.asked = rows, []

    def load(self, spark, options):
        text = re.sub(r" tablesample system \(([0-9.]+)\)", r"", options["query"])
        self.asked.append(options["query"])
        found = self.db.execute(text)
        names = [d[0] for d in found.description]
        kinds = ", ".join(f"{n} {'bigint' if n in ('n', 'tk_row') else 'string' if n in 'ku' else 'int'}" for n in names)
        return spark.createDataFrame([tuple(r) for r in found.fetchall()], kinds)

    def parts(self, predicates):
        return [self.db.execute(f"select * from t where {p}").fetchall() for p in predicates]


def uuid_of(rng):
    text = "%032x" % rng.getrandbits(128)
    return "-".join((text[:8], text[8:12], text[12:16], text[16:20], text[20:]))


def keys_of(kind, rng):
    """Rows and columns of each kind of key, crowded where equal ranges would be of no use."""
    if kind == "int":
        return [(int(10 ** (9 * rng.random())), None) for _ in range(3000)], [ColumnInfo("i", "int32", primary_key=True)]
    if kind == "text":
        words = ["o'brien", "Ab", "ab", "é", "zz", "\\"]
        return [(f"{rng.choice(words)}{rng.randrange(40)}", None) for _ in range(3000)], [ColumnInfo("k", "nvarchar", primary_key=True)]
    if kind == "uuid":
        return [(uuid_of(rng), None) for _ in range(3000)], [ColumnInfo("u", "uuid", primary_key=True)]
    # half of the rows have one first column
    rows = [("hot" if n % 2 else f"k{rng.randrange(50)}", n) for n in range(3000)]
    return rows, [ColumnInfo("k", "varchar", primary_key=True), ColumnInfo("i", "int32", primary_key=True)]


@pytest.mark.parametrize("kind", ["int", "text", "uuid", "pair"])
def test_parts_are_of_equal_size(spark, monkeypatch, kind):
    rows, keys = keys_of(kind, random.Random(kind))
    first = {"int": "i bigint", "text": "k text", "uuid": "u text", "pair": "k text"}[kind]
    source = Source(spark, rows, f"{first}, {'i' if kind == 'pair' else 'v'} int")
    monkeypatch.setattr(jdbc, "load", source.load)
    names = [k.name for k in keys]
    predicates = jdbc.split_predicates(spark, Endpoint("postgresql", url=URLS["postgresql"]), "t", names, keys, 8)
    parts = source.parts(predicates)
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, rows))
    sizes = [len(p) for p in parts]
    if kind != "text":  # one text has many rows there
        assert len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
    assert "count(*)" in source.asked[0] and "row_number() over (order by" in source.asked[1] and len(source.asked) == 2


def test_keys_that_may_be_null(spark, monkeypatch):
    rows = [(f"k{n % 40}" if n % 5 else None, n if n % 7 else None) for n in range(700)]
    keys = [ColumnInfo("k", "varchar"), ColumnInfo("i", "int32")]
    source = Source(spark, rows, "k text, i int")
    monkeypatch.setattr(jdbc, "load", source.load)
    predicates = jdbc.split_predicates(spark, Endpoint("postgresql", url=URLS["postgresql"]), "t", ["k", "i"], keys, 4)
    parts = source.parts(predicates)
    assert predicates[-1] == "k is null or i is null" and sorted(map(str, sum(parts, []))) == sorted(map(str, rows))
    empty = Source(spark, rows[:1], "k text, i int")
    empty.db.execute("delete from t")
    monkeypatch.setattr(jdbc, "load", empty.load)
    assert jdbc.split_predicates(spark, Endpoint("postgresql", url=URLS["postgresql"]), "t", ["i"], keys[1:], 4) == [
        "i is not null", "i is null"
    ]


def test_how_each_system_samples_and_orders():
    key = [ColumnInfo("k", "nvarchar"), ColumnInfo("n", "int64")]
    asked = {s: splits.cuts_query(s, "s.t", ["k", "n"], key, 8, 0.01) for s in SYSTEMS}
    assert "from s.t tablesample system (1.000000) where" in asked["postgresql"]
    assert "from s.t tablesample (1.000000 percent) where" in asked["mssql"] and "(tk_row * 8) % tk_rows < 8" in asked["mssql"]
    assert "from s.t where k is not null and n is not null and rand() < 0.01000000" in asked["mysql"]
    assert "from s.t sample (1.000000) where" in asked["oracle"]
    assert "order by nlssort(k, 'nls_sort=binary'), n)" in asked["oracle"]
    assert "order by k, n)" in asked["snowflake"] and "mod(tk_row * 8, tk_rows) < 8" in asked["snowflake"]
    assert "sample" not in splits.cuts_query("oracle", "s.t", ["k"], key[:1], 8, 1.0).replace("tk_", "")


def test_ranges_of_pairs():
    found = splits.range_predicates(["a", "b"], [["1", "'x'"], ["1", "'x'"], ["2", "'y'"]])
    assert found == [
        "a <= 1 and (a < 1 or (a = 1 and (b < 'x')))",
        "a >= 1 and (a > 1 or (a = 1 and (b >= 'x'))) and a <= 2 and (a < 2 or (a = 2 and (b < 'y')))",
        "a >= 2 and (a > 2 or (a = 2 and (b >= 'y')))",
    ]
    assert splits.beyond(["a"], ["1"]) == "a > 1" and splits.up_to(["a"], ["1"]) == "a <= 1"
    assert splits.range_predicates(["a"], []) == ["1 = 1"]


def test_text_keys_are_read_by_their_parts(spark, monkeypatch):
    from transferkit import read_table

    sent = {}
    monkeypatch.setattr(jdbc, "split_predicates", lambda s, e, t, names, keys, n: [f"{names} {[k.type for k in keys]} {n}"])
    monkeypatch.setattr(jdbc, "load_by_predicates", lambda s, e, t, predicates, infos: sent.update(p=predicates) or spark.range(1))
    source = Endpoint("oracle", url=URLS["oracle"])
    infos = [ColumnInfo("my id", "nvarchar", primary_key=True)]
    read_table(spark, source, "t", "s", key=["my id"], partitions=3, infos=infos)
    assert sent["p"] == ["['\"my id\"'] ['nvarchar'] 3"]
    with pytest.raises(ValueError, match="need infos"):
        read_table(spark, source, "t", "s", key=["a", "b"], partitions=3)


# Names of result columns by canonical type, as the drivers give them, and some of the drivers' own.
STATEMENTS = {
    "postgresql": {
        "nvarchar": "VARCHAR BPCHAR INTERVAL BOX CIRCLE LINE PATH POINT POLYGON LSEG INET MACADDR CIDR 1266 774 3220 5038 "
        "3615 3614 2970 timetz macaddr8 pg_lsn pg_snapshot tsquery tsvector txid_snapshot",
        "ntext": "TEXT", "int64": "INT8 bigserial", "int32": "INT4 serial", "int16": "INT2", "float64": "FLOAT8",
        "float32": "FLOAT4", "decimal": "NUMERIC", "datetime": "TIMESTAMP", "datetimetz": "TIMESTAMPTZ", "date": "DATE",
        "time": "TIME", "blob": "BYTEA", "uuid": "UUID", "bool": "BOOL", "json": "JSON JSONB", "xml": "142 xml",
        "varbit": "BIT VARBIT",
    },
    "mssql": {
        "nvarchar": "NVARCHAR NCHAR", "varchar": "VARCHAR CHAR", "ntext": "NTEXT", "text": "TEXT",
        "int64": "BIGINT bigint_identity", "int32": "INT int_identity", "int16": "SMALLINT TINYINT", "float64": "FLOAT",
        "float32": "REAL", "decimal": "DECIMAL NUMERIC decimal()_identity", "money": "MONEY SMALLMONEY",
        "datetime": "DATETIME2 DATETIME SMALLDATETIME", "datetimetz": "DATETIMEOFFSET", "date": "DATE", "time": "TIME",
        "varbinary": "BINARY timestamp", "blob": "IMAGE VARBINARY", "uuid": "UNIQUEIDENTIFIER", "bool": "BIT", "xml": "XML",
    },
    "mysql": {
        "nvarchar": "VARCHAR CHAR ENUM", "ntext": "TEXT TINYTEXT LONGTEXT", "int64": "BIGINT INT_UNSIGNED UNSIGNED_INT",
        "decimal": "DECIMAL BIGINT_UNSIGNED UNSIGNED_BIGINT", "int32": "INT MEDIUMINT SMALLINT_UNSIGNED UNSIGNED_SMALLINT",
        "int16": "YEAR SMALLINT TINYINT TINYINT_UNSIGNED UNSIGNED_TINYINT", "float64": "DOUBLE", "float32": "FLOAT",
        "datetime": "DATETIME", "datetimetz": "TIMESTAMP", "date": "DATE", "time": "TIME",
        "blob": "BINARY VARBINARY BLOB GEOMETRY LONGBLOB", "json": "JSON", "varbit": "BIT",
    },
    "oracle": {
        "nvarchar": "NCHAR CHAR VARCHAR2 NVARCHAR2 ROWID UROWID IntervalYM_DTY IntervalDS_DTY INTERVALYM INTERVALDS",
        "ntext": "OCIClobLocator LONG CLOB NCLOB", "float64": "IBDouble BINARY_DOUBLE FLOAT", "float32": "IBFloat BINARY_FLOAT",
        "decimal": "NUMBER", "datetime": "TimeStampDTY TIMESTAMP TIMESTAMP(6) DATE",
        "datetimetz": "TimeStampTZ_DTY TimeStampLTZ_DTY TIMESTAMP(3)_WITH_TIME_ZONE TIMESTAMP_WITH_LOCAL_TIME_ZONE",
        "varbinary": "RAW", "blob": "OCIBlobLocator OCIFileLocator BLOB BFILE",
    },
    "snowflake": {
        "nvarchar": "TEXT VARCHAR VARIANT ARRAY OBJECT", "float64": "REAL FLOAT DOUBLE", "decimal": "FIXED NUMBER",
        "datetime": "TIMESTAMP_NTZ TIMESTAMPNTZ", "datetimetz": "TIMESTAMP_LTZ TIMESTAMP_TZ TIMESTAMPTZ", "date": "DATE",
        "time": "TIME", "varbinary": "BINARY", "bool": "BOOLEAN",
    },
}


@pytest.mark.parametrize("system", list(SYSTEMS))
def test_types_of_a_statement(spark, system):
    pairs = [(n.replace("_", " ") if system in ("mssql", "mysql") or " " in n.replace("_WITH_", " ") or "_WITH_" in n else n, t)
             for t, names in STATEMENTS[system].items() for n in names.split()]
    columns = [(f"c{i}", name, 0, 0, True) for i, (name, _) in enumerate(pairs)]
    infos = metadata.query_infos(spark, system, columns)
    assert [(i.name, i.type) for i in infos] == [(f"c{n}", t) for n, (_, t) in enumerate(pairs)]
    assert all((i.precision, i.scale, i.length) == (-1, -1, -1) for i in infos)
    with pytest.raises(Exception, match="unsupported database type"):
        metadata.query_infos(spark, system, [("c", "no such type", 0, 0, True)])


def test_sizes_of_a_statement(spark):
    columns = [("a", "numeric", 12, 3, True), ("b", "numeric", 0, 0, True), ("c", "varchar", 40, 0, False), ("d", "text", 2**31 - 1, 0, True)]
    infos = metadata.query_infos(spark, "postgresql", columns)
    assert [(i.type, i.precision, i.scale, i.length) for i in infos] == [
        ("decimal", 12, 3, 12), ("decimal", -1, -1, -1), ("nvarchar", 40, 0, 40), ("ntext", -1, -1, -1)
    ]
    assert metadata.query_infos(spark, "oracle", [("n", "NUMBER", 0, -127, True)])[0].precision == -1


def test_names_by_position():
    assert metadata.unique_names(["a", "b", "A", "a", "a_2", ""]) == ["a", "b", "A_3", "a_4", "a_2", "column_6"]
    assert metadata.unique_names(["x", "y"]) == ["x", "y"]
    assert metadata.positional("mssql", "select 1, 2", ["c0", "c1"]) == "(select 1, 2) q (c0, c1)"
    assert metadata.positional("oracle", "select 1 x from dual", ["c0"]) == "(with q (c0) as (select 1 x from dual) select * from q)"


def test_a_query_is_wrapped_only_where_names_clash():
    source = Endpoint("postgresql", url=URLS["postgresql"])
    infos = [ColumnInfo("id", "int64"), ColumnInfo("t", "time")]
    plain = jdbc.query_plan(source, "select id, t from x;", ["id", "t"], infos)
    assert plain["query"] == "select id, t from x" and plain["customSchema"] == "`t` STRING"
    infos = [ColumnInfo("id", "int64"), ColumnInfo("id_2", "time")]
    both = jdbc.query_plan(source, "select id, t id from x", ["id", "id"], infos, Partitioning("ID", 0, 9, 3))
    assert both["dbtable"] == "(select id, t id from x) q (c0, c1)" and both["partitionColumn"] == "c0"
    assert both["customSchema"] == "`c1` STRING" and "query" not in both
    with pytest.raises(ValueError, match="no column k"):
        jdbc.query_plan(source, "select id, t id from x", ["id", "id"], infos, Partitioning("k", 0, 9, 3))


def test_a_transfer_takes_types_from_the_statement(spark, monkeypatch, folder):
    """A query's result keeps what Spark's schema forgets; the same columns without it would be plain text."""
    from transferkit import transfer

    columns = [("id", "int8", 19, 0, False), ("id", "uuid", 2**31 - 1, 0, True), ("doc", "jsonb", 2**31 - 1, 0, True), ("n", "numeric", 0, 0, True)]
    text = "0f0e0d0c-0b0a-0908-0706-050403020100"
    asked = []
    monkeypatch.setattr(metadata, "statement_columns", lambda s, e, query: asked.append(query) or columns)
    result = spark.createDataFrame([(1, text, "{}", "12.50")], "c0 long, c1 string, c2 string, c3 string")
    monkeypatch.setattr(jdbc, "load", lambda s, options: asked.append(options["dbtable"]) or result)
    moved = transfer(
        spark, Endpoint("postgresql", url=URLS["postgresql"]), Endpoint("mysql"), "t", "s",
        query="select * from a natural join b;", load_path=f"{folder}/out",
    )
    assert asked[:2] == ["select * from a natural join b", "(select * from a natural join b) q (c0, c1, c2, c3)"]
    assert [(c.name, c.type) for c in moved.columns] == [("id", "int64"), ("id_2", "uuid"), ("doc", "json"), ("n", "decimal")]
    line = spark.read.text(f"{folder}/out").first()[0]
    assert line == "1," + text.replace("-", "") + ",{},12.50"


class Changing(Source):
    """A table that changes while it is followed."""

    def __init__(self, spark):
        super().__init__(spark, [(0, 0, "first")], "m bigint, i bigint, v text")
        self.spark = spark

    def load(self, spark, options):
        found = self.db.execute(options["query"])
        names = [d[0] for d in found.description]
        return spark.createDataFrame([tuple(r) for r in found.fetchall()], ", ".join(f"{n} bigint" for n in names))

    def load_by_predicates(self, spark, source, table, predicates, infos):
        rows = [r for p in predicates for r in self.db.execute(f"select * from t where {p}").fetchall()]
        return spark.createDataFrame([tuple(r) for r in rows], "m long, i long, v string")

    def add(self, rows):
        self.db.executemany("insert into t values (?, ?, ?)", rows)

    def change(self, i, mark, value):
        self.db.execute("update t set m = ?, v = ? where i = ?", [mark, value, i])

    def all(self):
        return sorted(self.db.execute("select * from t").fetchall())


def test_a_table_is_followed(spark, folder, monkeypatch):
    from transferkit import ChangeLog
    from transferkit.streaming.tables import TableStream, follow_table

    table = Changing(spark)
    monkeypatch.setattr(jdbc, "load", table.load)
    monkeypatch.setattr(jdbc, "load_by_predicates", table.load_by_predicates)
    infos = [ColumnInfo("m", "int64"), ColumnInfo("i", "int64", primary_key=True), ColumnInfo("v", "ntext")]
    stream = TableStream(POSTGRES, "t", infos, "m", ("i",), f"{folder}/checkpoint", rows_per_batch=7)
    log = ChangeLog(f"{folder}/log", ("i",))
    table.add([(n // 10, n, f"v{n}") for n in range(1, 30)])  # many rows of one mark
    assert follow_table(spark, stream, log) == 5
    state = lambda: sorted(map(tuple, log.current(spark).collect()))
    assert state() == table.all() and follow_table(spark, stream, log) == 0
    sizes = [log.read(spark, [b]).count() for b in log.batches(spark)]
    assert sizes == [7, 7, 7, 7, 2]
    table.change(3, 50, "changed")
    table.add([(50, 100 + n, "new") for n in range(8)])

    # cut off after the batch is written but not committed, and while the table goes on changing
    handled = []

    def broken(rows, epoch):
        handled.append((epoch, rows.count()))
        log.apply_epoch(rows, epoch, stream.checkpoint)
        raise ConnectionError("gone")

    with pytest.raises(ConnectionError):
        stream.run(spark, broken)
    table.add([(51, 200 + n, "newer") for n in range(3)])
    assert handled == [(5, 7)] and follow_table(spark, stream, log) == 2
    assert state() == table.all()
    assert [log.read(spark, [b]).count() for b in log.batches(spark)] == [7, 7, 7, 7, 2, 7, 5]
    assert len(stream.offsets(spark)) == stream.committed(spark) == 7
    held = TableStream(POSTGRES, "t", infos, "m", ("i",), f"{folder}/other", hold_back="50")
    seen = []
    held.run(spark, lambda rows, epoch: seen.append(rows.count()))
    assert seen == [len(table.all()) - 3]
