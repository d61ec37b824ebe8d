from tabulaire.operators import Standard
from tabulaire.streaming import complete_cases, normalize, scale_stream, select_features

SCHEMA = "id long, a double, b double"


def test_row_operators_run_on_streams(spark, tmp_path):
    table = spark.createDataFrame([(1, 3.0, 4.0), (2, None, 1.0), (3, 0.0, 2.0)], SCHEMA)
    table.write.parquet(str(tmp_path / "in"))
    scaler = Standard(["a", "b"])
    fitted = scaler.fit(table)
    stream = complete_cases(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))

    def drained(df, name):
        query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        query.processAllAvailable()
        query.stop()
        return sorted(map(tuple, spark.table(name).collect()))

    assert drained(normalize(stream, "l2", ["a", "b"]), "normed") == [(1, 0.6, 0.8), (3, 0.0, 1.0)]
    assert drained(select_features(stream, ["b", "id"]), "chosen") == [(2.0, 3), (4.0, 1)]
    assert drained(scale_stream(stream, scaler, fitted), "scaled") == sorted(map(tuple, complete_cases(scaler.transform(table, fitted)).collect()))
