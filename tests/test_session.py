from __future__ import annotations

from types import SimpleNamespace

import pytest

from affinis import session as S


def fake(master="yarn", **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(applicationId="app-1", master=master))


def test_the_shared_folder_is_the_sessions():
    session = fake(spark_checkpoint_dir="s3://b/c/", spark_sql_warehouse_dir="s3://w")
    assert S.shared_dir(session) == "s3://b/c/affinis-app-1"
    assert S.scratch_path(session, "x").startswith("s3://b/c/affinis-app-1/x-")


def test_without_a_shared_folder_only_one_machine_works():
    assert S.shared_dir(fake("local[4]", spark_sql_warehouse_dir="file:/w")) == "file:/w/affinis-app-1"
    for master in ("yarn", "spark://h:1", "local-cluster[3,2,900]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            S.shared_dir(fake(master, spark_sql_warehouse_dir="file:/w"))


def test_release_drops_scratch_tables(spark):
    name = S.scratch_table(spark, "units")
    spark.range(3).write.option("path", S.scratch_path(spark, "units")).saveAsTable(name)
    other = spark.range(2).write.saveAsTable("somebody_elses")
    S.release_stages(spark)
    assert [r["tableName"] for r in spark.sql("SHOW TABLES").collect()] == ["somebody_elses"] and other is None
    spark.sql("DROP TABLE somebody_elses")


def test_stages_keep_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "map('a', id) as m", "array(id, null) as xs")
    back = S.cut_lineage(df)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(r["id"] for r in back.collect()) == list(range(10))


def test_small_inputs_use_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert S.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    assert S.spread(spark.range(10).repartition(cores)).rdd.getNumPartitions() == cores
