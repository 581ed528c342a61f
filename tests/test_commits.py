"""Staged JDBC commits (K4, D6) and all tables of a batch at once (K1, K3): re-runs, kills, conflicts."""

from __future__ import annotations

import tempfile
import uuid

import pytest

from itemstats.sinks import external, store

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
SCHEMA = "paper_code string, create_time string, item_id int, nandu double, note string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def batches(spark, rows):
    return spark.createDataFrame(rows, "paper_code string, create_time string")


OLD = [("P", "1", 1, 0.5, "a,b"), ("P", "1", 1, 0.5, "a,b"), ("P", "1", 2, None, None), ("Q", "1", 1, 0.75, "ü'\""), (None, "1", 3, 0.1, "")]
NEW = [("P", "1", 1, 0.25, "x")]


NAMED = OLD[:4]  # Spark writes a null key as a CLOB, which embedded Derby refuses


@pytest.fixture
def db(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"  # inside the Spark JVM: no server, no port

    def rows(table):
        return sorted((tuple(r) for r in spark.read.jdbc(url, table, properties=DRIVER).select("paper_code", "create_time", "item_id", "nandu", "note").collect()), key=str)

    return url, rows


def test_jdbc_rerun_leaves_one_copy(spark, db):
    url, rows = db
    for _ in range(2):  # the same batches again, as another run
        assert external.commit_jdbc({"T_ONE": frame(spark, NAMED), "T_TWO": frame(spark, NAMED[:1])}, url, DRIVER)
        assert rows("T_ONE") == sorted(NAMED, key=str) and rows("T_TWO") == NAMED[:1]
    external.commit_jdbc({"T_ONE": frame(spark, NEW)}, url, DRIVER)
    assert rows("T_ONE") == sorted(NEW + NAMED[3:], key=str) and rows("T_TWO") == NAMED[:1]
    external.commit_jdbc({"T_ONE": frame(spark, [])}, url, DRIVER, analysed=batches(spark, [("P", "1"), ("Z", "9")]))
    assert rows("T_ONE") == NAMED[3:4]  # analysed batches without a row are emptied


def test_jdbc_epoch_is_applied_once(spark, db):
    url, rows = db
    assert external.commit_jdbc({"T": frame(spark, NAMED)}, url, DRIVER, epoch="7")
    assert not external.commit_jdbc({"T": frame(spark, NEW)}, url, DRIVER, epoch="7")
    assert rows("T") == sorted(NAMED, key=str)


@pytest.mark.parametrize("broken", ["_replace", "INSERT INTO T_TWO", "INSERT INTO itemstats_epochs"])
def test_jdbc_killed_run_changes_nothing(spark, db, monkeypatch, broken):
    url, rows = db
    external.commit_jdbc({"T_ONE": frame(spark, NAMED), "T_TWO": frame(spark, NAMED)}, url, DRIVER)

    def kill(*a):
        raise KeyboardInterrupt

    run = external._run
    with monkeypatch.context() as m:
        if broken.startswith("_"):
            m.setattr(external, broken, kill)
        else:  # in the middle of the transaction
            m.setattr(external, "_run", lambda con, sql, *v: kill() if sql.startswith(broken) else run(con, sql, *v))
        with pytest.raises(KeyboardInterrupt):
            external.commit_jdbc({"T_ONE": frame(spark, NEW), "T_TWO": frame(spark, NEW)}, url, DRIVER, epoch="8")
    assert rows("T_ONE") == rows("T_TWO") == sorted(NAMED, key=str)
    assert external.commit_jdbc({"T_ONE": frame(spark, NEW), "T_TWO": frame(spark, NEW)}, url, DRIVER, epoch="8")  # over what the kill left
    assert rows("T_ONE") == rows("T_TWO") == sorted(NEW + NAMED[3:], key=str)


def test_jdbc_rows_staged_twice_are_staged_again(spark, db, monkeypatch):
    url, rows = db
    write, calls = external.write_jdbc, []

    def twice(df, url, table, properties=None, mode="append", *a, **options):
        write(df, url, table, properties, mode, *a, **options)
        if table.startswith("T_stg") and not calls:  # a task that ran again after its rows were stored
            calls.append(table)
            write(df, url, table, properties, "append", *a, **options)

    monkeypatch.setattr(external, "write_jdbc", twice)
    external.commit_jdbc({"T": frame(spark, NAMED)}, url, DRIVER)
    assert calls and rows("T") == sorted(NAMED, key=str)


def got(spark, root, table, **kw):
    return sorted((tuple(r) for r in store.read(spark, root, table, **kw).select("paper_code", "create_time", "item_id", "nandu", "note").collect()), key=str)


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="itemstats-store-") + "/results"


def test_store_replaces_all_tables_of_a_batch(spark, root):
    with pytest.raises(ValueError):
        got(spark, root, "one")
    assert store.commit({"one": frame(spark, OLD), "two": frame(spark, OLD[3:])}, root) == 1
    assert got(spark, root, "one") == sorted(OLD, key=str) and got(spark, root, "two") == sorted(OLD[3:], key=str)
    # 0123 stays as written; P is analysed and gives nothing in table two
    assert store.commit({"one": frame(spark, NEW + [("0123", "1", 1, 0.0, None)]), "two": frame(spark, [])}, root, batches(spark, [("P", "1"), ("0123", "1"), (None, "1")])) == 2
    assert got(spark, root, "one") == sorted(NEW + OLD[3:4] + [("0123", "1", 1, 0.0, None)], key=str)
    assert got(spark, root, "two") == OLD[3:4]
    assert got(spark, root, "one", paper_code="P", create_time="1") == NEW
    assert got(spark, root, "one", version=1) == sorted(OLD, key=str)  # an older commit stays readable
    assert len(store.vacuum(spark, root, keep=2)) == 0 and len(store.vacuum(spark, root)) == 0  # Q is still of run 1
    store.commit({"one": frame(spark, OLD[3:4]), "two": frame(spark, OLD[3:4])}, root)
    assert len(store.vacuum(spark, root)) == 1 and got(spark, root, "two") == OLD[3:4] and store.latest(spark, root) == 3


@pytest.mark.parametrize("at", ["two", "_publish"])
def test_store_failure_between_tables_shows_the_old_batch_everywhere(spark, root, monkeypatch, at):
    store.commit({"one": frame(spark, OLD), "two": frame(spark, OLD)}, root)

    class Killed(DataFrameLike):
        pass

    with monkeypatch.context() as m:
        if at == "_publish":
            m.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        two = frame(spark, NEW) if at == "_publish" else Killed(frame(spark, NEW))
        with pytest.raises(KeyboardInterrupt):
            store.commit({"one": frame(spark, NEW), "two": two}, root)
    assert got(spark, root, "one") == got(spark, root, "two") == sorted(OLD, key=str)
    store.commit({"one": frame(spark, NEW), "two": frame(spark, NEW)}, root)
    assert got(spark, root, "one") == got(spark, root, "two") == sorted(NEW + OLD[3:], key=str)


class DataFrameLike:
    """A result whose write is killed."""

    def __init__(self, df):
        self.columns, self.sparkSession, self.schema = df.columns, df.sparkSession, df.schema

    def select(self, *a):
        raise KeyboardInterrupt


def test_store_two_commits_at_once(spark, root, monkeypatch):
    publish, raced = store._publish, []

    def race(spark_, path, text):
        if not raced:  # another commit takes the number first
            raced.append(path)
            store.commit({"one": frame(spark, OLD[3:4])}, root)
        return publish(spark_, path, text)

    monkeypatch.setattr(store, "_publish", race)
    assert store.commit({"one": frame(spark, NEW)}, root) == 2
    assert got(spark, root, "one") == sorted(NEW + OLD[3:4], key=str)
