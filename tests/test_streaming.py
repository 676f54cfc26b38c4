"""A stream of spots gives what the batch plan gives."""

from spotlattice.operators import assign, geometry
from spotlattice.streaming.spots import assign_stream


def test_stream_agrees_with_batch(spark, tmp_path):
    rings = [(k, [10.0 * k, 10.0 * k + 8, 10.0 * k + 8, 10.0 * k], [0.0, 0.0, 8.0, 8.0]) for k in range(5)]
    regions = geometry.region_edges(spark.createDataFrame(rings, "cell_id long, xs array<double>, ys array<double>"), "cell_id")
    data = spark.createDataFrame([(i, (i * 7 % 500) / 10, (i * 3 % 90) / 10) for i in range(600)], "spot long, x double, y double")
    src = str(tmp_path / "in")
    for k in range(2):
        data.filter(f"spot % 2 = {k}").coalesce(1).write.mode("append").parquet(src)
        q = assign_stream(spark.readStream.schema(data.schema).parquet(src), regions, str(tmp_path / "out"), str(tmp_path / "state"))
        q.awaitTermination(120)
    got = {(r.spot, r.cell_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(r.spot, r.cell_id) for r in assign.assign_spots(data, regions).collect()} and len(got) > 100
