from roundstats.operators import words as W
from roundstats.sources import read_documents
from roundstats.streaming import stream_word_count


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("the cat\nthe dog the\n")
    (src / "b.txt").write_text("a  b  \n\nx y x\n")
    q = (stream_word_count(spark, str(src), max_files_per_trigger=1)
         .writeStream.outputMode("complete").format("memory").queryName("wc_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql("SELECT word, n FROM wc_stream").collect())
    want = sorted(tuple(r) for r in W.word_count(read_documents(spark, str(src))).collect())
    assert got == want
