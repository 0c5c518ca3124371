from conftest import payload
from skyledger.streaming import replay


def test_slice_is_many_files_and_one_micro_batch(spark, messages, tmp_path):
    """No task makes or reads a whole slice, and slices with few rows or none are micro-batches of their own."""
    sizes = [40, 0, 3, 20]
    slices = [messages([payload(message_id=f"{n}-{k}") for k in range(size)]).repartition(8) for n, size in enumerate(sizes)]
    files = replay.files_a_slice(spark)
    assert files == 4
    folder = replay.write_slices(slices, str(tmp_path / "slices"), files)
    per_file = spark.read.parquet(folder).selectExpr("_metadata.file_name as name").groupBy("name").count().collect()
    assert max(r["count"] for r in per_file) < max(sizes)
    seen = []
    query = (
        replay.replay(spark, folder, files).writeStream
        .foreachBatch(lambda rows, _: seen.append(sorted(r.v for r in rows.selectExpr("get_json_object(string(value), '$.message_id') as v").collect())))
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert seen == [sorted(f"{n}-{k}" for k in range(size)) for n, size in enumerate(sizes)]
