from foldwise.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


def test_stream_writes_parquet_not_a_driver_table(spark):
    out = REGISTRY["stream_feature_scoring"].run(spark, SF)
    assert out.inputFiles() and all("stream-out" in f for f in out.inputFiles())
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("fw_stream")]
    assert out.count() == out.select("id").distinct().count() > 0
