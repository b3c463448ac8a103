from helixframe.operators.row_validation import bad_lines, clean_rows
from helixframe.streaming.lines import line_stream, load_lines


def test_streamed_lines_equal_the_batch(spark, tmp_path):
    good = 'c\ts\texon\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t";'
    rows = [(i, "f", good if i % 3 else good + "\tx") for i in range(30)]
    df = spark.createDataFrame(rows, "line_id long, file_name string, line string")
    df.where("line_id < 15").write.parquet(str(tmp_path / "in" / "a"))
    df.where("line_id >= 15").write.parquet(str(tmp_path / "in" / "b"))
    paths = [str(tmp_path / p) for p in ("good", "bad", "ckpt")]
    load_lines(line_stream(spark, str(tmp_path / "in" / "*")), *paths).awaitTermination(60)
    assert spark.read.parquet(paths[0]).drop("batch").exceptAll(clean_rows(df)).count() == 0
    assert spark.read.parquet(paths[0]).count() == 20
    assert sorted(tuple(r) for r in spark.read.parquet(paths[1]).select("line_id", "reason").collect()) == sorted(tuple(r) for r in bad_lines(df).collect())
