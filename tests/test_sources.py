from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardlens.sources.clinical import LAYOUT, load, load_catalog, load_parquet, report_columns
from wardlens.sources.staging import Stage, shared_folder
from wardlens.sources.tables import save_result


def test_columns_are_renamed_and_cast_only_where_needed(rows):
    source = rows(
        "pat_id bigint, DX_ID bigint, NOTED_DATE timestamp_ntz, NOTED_END_DATE date, extra int",
        [(5, 6, datetime(2024, 1, 2, 3, 4), date(2024, 1, 3), 1)],
    )
    found = report_columns(source, "problems")
    # A time of day stays.
    assert tuple(found.first()) == ("5", 6, datetime(2024, 1, 2, 3, 4), date(2024, 1, 3))
    assert "cast(dx_id" not in found._jdf.queryExecution().analyzed().toString().lower()


def test_parquet_round_trip(spark, tmp_path):
    for role, (table, columns) in LAYOUT.items():
        fields = [
            F.lit(None).cast("double" if kind == "keep" else kind).alias(source)
            for source, kind in columns.values()
        ]
        save_result(spark.range(1).select(*fields), f"{tmp_path}/{table}.parquet")
    tables = load_parquet(spark, str(tmp_path))
    assert set(tables) == set(LAYOUT)
    assert tables["encounters"].columns == list(LAYOUT["encounters"][1])


def test_catalog_names(spark):
    for _, (table, columns) in LAYOUT.items():
        fields = [
            F.lit(None).cast("double" if kind == "keep" else kind).alias(source.lower())
            for source, kind in columns.values()
        ]
        spark.range(1).select(*fields).createOrReplaceTempView(table.lower())
    assert load_catalog(spark)["infections"].columns == [
        "patient_id", "infection_type", "infection_status",
    ]


def test_staged_tables_lie_in_the_shared_folder(spark):
    stage = Stage(spark)
    assert stage.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = stage.keep(spark.range(10).withColumn("x", F.col("id") * 2), "numbers")
    assert kept.agg(F.sum("x")).first()[0] == 90
    assert Stage(spark).folder != stage.folder


class Settings(dict):
    def get(self, name, default=None):
        return super().get(name, default)


class Session:
    def __init__(self, **conf):
        self.conf = Settings({name.replace("_", "."): value for name, value in conf.items()})


def test_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark_master="yarn"))
    named = Session(spark_master="yarn")
    named.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared_folder(named) == "hdfs:///shared"


def test_local_sessions_get_one_scratch_folder():
    class Context:
        applicationId = "local-1"

    session = Session(spark_master="local[2]")
    session.sparkContext = Context()
    assert shared_folder(session) == shared_folder(session)
    assert "local-1" in shared_folder(session)


def test_folder_of_one_machine_is_refused_on_a_cluster():
    named = Session(spark_master="yarn")
    named.conf["spark.checkpoint.dir"] = "file:///tmp/x"
    with pytest.raises(ValueError, match="one machine"):
        shared_folder(named)


def test_stage_removes_its_folder_at_the_end_and_after_an_error(spark):
    with Stage(spark) as stage:
        stage.keep(spark.range(3), "numbers")
        assert Path(stage.folder.removeprefix("file:")).exists()
    assert not Path(stage.folder.removeprefix("file:")).exists()
    with pytest.raises(RuntimeError), Stage(spark) as stage:
        stage.keep(spark.range(3), "numbers")
        raise RuntimeError
    assert not Path(stage.folder.removeprefix("file:")).exists()


def test_tables_are_opened_on_demand(spark):
    def open_table(name):
        if name != "INFECTIONS":
            raise LookupError(name)
        return spark.sql("SELECT '1' AS PAT_ID, '85' AS INFECTION_TYPE_C, '1' AS INF_STATUS_C")

    tables = load(open_table)
    assert tables["infections"].count() == 1
    with pytest.raises(LookupError):
        tables["services"]
