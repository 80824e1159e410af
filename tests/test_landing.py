from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from ledgersieve.schemas import BRONZE_TABLES, CORRUPTION_LOG, SUPPLIERS_RAW
from ledgersieve.sources import files
from ledgersieve.sources.cut import CHECKPOINT_CONF, cut, work_folder
from ledgersieve.sources.landing import landed_files, load_bronze, read_bronze, read_landing, write_landing
from ledgersieve.sources.tables import Warehouse, view


def test_missing_and_blank_are_told_apart(spark, tmp_path, rows):
    (tmp_path / "suppliers.csv").write_text('id,n,c,t,d\nS1,"A, ""B""",,"",x\n')
    assert rows(read_landing(spark, str(tmp_path), "suppliers", SUPPLIERS_RAW)) == [("S1", 'A, "B"', None, "", "x")]


def test_columns_go_by_position_not_by_header(spark, tmp_path):
    with gzip.open(tmp_path / "corruption_log.csv.gz", "wt") as f:
        f.write("table,record_id,issue_type,detail,ml_target\npo_items,P|10,price_outlier,x50,True\n")
    row = read_landing(spark, str(tmp_path), "corruption_log", CORRUPTION_LOG).first()
    assert (row["table_name"], row["ml_target"]) == ("po_items", "True")


def test_a_short_row_stops_the_load(spark, tmp_path):
    (tmp_path / "suppliers.csv").write_text("a,b,c,d,e\nS1,x\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_landing(spark, str(tmp_path), "suppliers", SUPPLIERS_RAW).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "suppliers.csv").write_text('a,b,c,d,e\nS1,"two\nlines",c,t,d\n')
    assert read_landing(spark, str(tmp_path), "suppliers", SUPPLIERS_RAW, multiline=True).first()["name"] == "two\nlines"


def test_round_trip_reload_and_listing(spark, tmp_path, rows):
    values = [("x", None, "", 'say "hi", ok', "ž")]
    tables = {}
    for stem, (_, schema) in BRONZE_TABLES.items():
        width = len(schema.fields)
        tables[stem] = spark.createDataFrame([tuple((values[0] * 2)[:width])] * 3, schema)
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    write_landing(tables, landing)
    for _ in range(2):
        audit = {r["table_name"]: r["rows_loaded"] for r in load_bronze(spark, landing, bronze).collect()}
        assert audit == {name: 3 for name, _ in BRONZE_TABLES.values()}
    for stem, df in tables.items():
        assert rows(read_bronze(spark, bronze, stem)) == rows(df)
    files = landed_files(spark, landing).collect()
    assert len(files) >= 5 and all(f["bytes"] > 0 and ".csv" in f["path"] for f in files)


def test_quoted_line_breaks_survive_a_load(spark, tmp_path, rows):
    tables = {stem: spark.createDataFrame([("two\nlines",) * len(schema)], schema)
              for stem, (_, schema) in BRONZE_TABLES.items()}
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    write_landing(tables, landing)
    load_bronze(spark, landing, bronze, multiline=True)
    for stem, df in tables.items():
        assert rows(read_bronze(spark, bronze, stem)) == rows(df)


def test_a_reload_that_stops_half_way_leaves_the_old_rows(spark, tmp_path, rows):
    tables = {stem: spark.createDataFrame([("old",) * len(schema)], schema) for stem, (_, schema) in BRONZE_TABLES.items()}
    good, bad, bronze = str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "bronze")
    write_landing(tables, good)
    load_bronze(spark, good, bronze)
    newer = {stem: df.replace("old", "new") for stem, df in tables.items()}
    write_landing({stem: df for stem, df in newer.items() if stem != "corruption_log"}, bad)
    (tmp_path / "bad" / "corruption_log.csv").write_text("a,b,c,d,e\none,two\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        load_bronze(spark, bad, bronze)
    for stem, df in tables.items():
        assert rows(read_bronze(spark, bronze, stem)) == rows(df)


def test_readers_of_the_version_before_are_not_disturbed(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    assert not store.exists("silver", "t")
    first = store.replace("silver", "t", spark.range(5))
    with pytest.raises(Exception, match="lost"):
        store.replace("silver", "t", spark.range(9).select(F.raise_error(F.lit("lost")).alias("id")))
    assert store.table("silver", "t").count() == 5
    store.replace("silver", "t", spark.range(3))
    assert (first.count(), store.table("silver", "t").count()) == (5, 3)
    folder = store.path("silver", "t")
    before = len(files.names(spark, folder))
    store.replace("silver", "t", spark.range(2))
    assert len(files.names(spark, folder)) == before  # the version before the last is gone


def test_a_name_is_given_once(spark, tmp_path):
    for n in (1, 2):
        spark.range(n).write.parquet(f"{tmp_path}/_aside{n}")
    files.publish(spark, f"{tmp_path}/_aside1", f"{tmp_path}/runs/one")
    with pytest.raises(files.Taken):
        files.publish(spark, f"{tmp_path}/_aside2", f"{tmp_path}/runs/one")
    assert spark.read.parquet(f"{tmp_path}/runs/one").count() == 1


def test_replace_and_view(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    store.replace("silver", "t", spark.range(5))
    assert store.replace("silver", "t", spark.range(3)).count() == 3
    assert store.table("silver", "t").count() == 3
    view("small", store.table("silver", "t").where("id < 2"))
    assert spark.sql("select count(*) from small").first()[0] == 2


def test_cut_points_go_to_the_folder_the_session_names(spark, rows):
    assert work_folder(spark) == spark.conf.get(CHECKPOINT_CONF)
    stored = cut(spark.range(4), "four")
    assert rows(stored) == [(0,), (1,), (2,), (3,)]
    assert all(work_folder(spark) in f for f in stored.inputFiles())
    assert cut(spark.range(0), "none").count() == 0


def test_without_a_shared_folder_nothing_is_stored():
    class Unset:
        class conf:  # noqa: N801
            get = staticmethod(lambda *args: None)

        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match=CHECKPOINT_CONF):
        work_folder(Unset)
