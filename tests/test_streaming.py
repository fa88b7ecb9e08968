import plumbline as pl
from plumbline.streaming.apply import read_stream, transform_stream, write_stream


def test_fitted_transforms_give_the_batch_result(spark, tmp_path):
    source = "/root/testdata/sf0.001/part.parquet"
    parts = spark.read.parquet(source)
    folder = tmp_path / "in"
    parts.repartition(3).write.parquet(str(folder))
    spec = pl.TableSpec("p_retailprice", "numerical", ("p_brand", "p_type"), ("p_name",), key=("p_partkey",))
    band = pl.QuantileBand("p_retailprice").fit(parts)
    prep = pl.Preprocessor.of(parts, spec, scaling=True).fit(parts)
    steps = [band.apply, lambda df: prep.transform(df, keep=["p_partkey", "p_retailprice"])]
    stream = transform_stream(read_stream(spark, str(folder), parts.schema), steps)
    assert stream.isStreaming
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = transform_stream(parts, steps)
    assert got.count() == 200
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_broadcast_mapping_joins_a_stream(spark, tmp_path, monkeypatch):
    from plumbline.operators import encoding

    monkeypatch.setattr(encoding, "LITERAL_CODES", 0)
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    folder = tmp_path / "in"
    parts.write.parquet(str(folder))
    encoder = pl.OrdinalEncoder("p_brand", "p_partkey").fit(parts)
    stream = encoder.apply(read_stream(spark, str(folder), parts.schema))
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.exceptAll(encoder.apply(parts)).count() == 0 and got.count() == 200
