import pytest

from roundstats.__main__ import build, run


def test_numbers_program(spark, tmpdir_text):
    path = tmpdir_text("dataset.txt", "\n".join(f"{i}.0" for i in range(1, 11)) + "\n")
    r = run(spark, build(["numbers", path])).first()
    assert (r["n"], r["max_v"], r["max_by_order"], r["min_v"]) == (10, 10.0, 10.0, 1.0)
    assert r["median_nv"] == pytest.approx(4 / 9) and r["mean_nv"] == pytest.approx(0.5)


def test_words_program(spark, tmpdir_text):
    path = tmpdir_text("docs.txt", "the cat\nthe dog the\n")
    rows = run(spark, build(["words", "3", path])).collect()
    assert {(r["n_docs"], r["n_words"], r["avg_len"]) for r in rows} == {(2, 3, 3.0)}


def test_cluster_programs(spark, tmpdir_text):
    lines = "\n".join(f"{i % 7}.0 {i % 3}.5 {i}.25" for i in range(40)) + "\n"
    path = tmpdir_text("points.txt", lines)
    assert run(spark, build(["cluster", path, "3", "2"])).first()["objective"] > 0
    r = run(spark, build(["mr-cluster", path, "3", "2", "1"])).first()
    assert r["n_points"] == 40 and r["objective"] > 0


def test_main_writes_parquet(spark, tmpdir_text, tmp_path):
    from roundstats.__main__ import main

    path = tmpdir_text("docs.txt", "a b a\nc\n")
    out = str(tmp_path / "report")
    assert main(["--out", out, "words", "2", path]) == 0
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 3 and {r["n_words"] for r in rows} == {3}


def test_numbers_program_needs_a_number(spark, tmpdir_text):
    path = tmpdir_text("bad.txt", "x -1 NaN\n")
    with pytest.raises(ValueError):
        run(spark, build(["numbers", path]))
