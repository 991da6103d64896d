"""Models, profiles and small tables around a run."""

import json

import pytest

from brackish.operators import classify
from brackish.sources import models, readers
from brackish.streaming import incremental


def test_model_round_trip(spark, tmp_path):
    refs = spark.createDataFrame([(1, "ACGTACGTTGCA", "K;P"), (2, "TTGACCATGGAC", "K;Q")], "seq_id long, seq string, lineage string")
    words, classes = classify.wang_train(refs)
    models.save({"words": words, "classes": classes}, f"{tmp_path}/m", "wang", "word", k=8)
    parts, settings = models.load(spark, f"{tmp_path}/m", "wang")
    assert settings == {"k": 8} and parts["words"].exceptAll(words).isEmpty() and parts["classes"].count() == 2
    with pytest.raises(ValueError, match="wang"):
        models.load(spark, f"{tmp_path}/m", "flat")
    with pytest.raises(FileNotFoundError):
        models.load(spark, f"{tmp_path}/none")
    registry = {"16S": {"general": "g", "oral": "o"}}
    assert models.model_path(registry, "16s", "ORAL") == "o"
    for marker, kind in (("18S", "general"), ("16S", "gut")):
        with pytest.raises(ValueError, match="there are"):
            models.model_path(registry, marker, kind)


def test_profile_and_pairs(spark, tmp_path):
    (tmp_path / "p.yml").write_text("# run\nmode: ref\nidentity: 0.97  # share\nthreads: 16\nchimera: true\nempty:\n")
    assert models.profile(f"{tmp_path}/p.yml") == {"mode": "ref", "identity": 0.97, "threads": 16, "chimera": True, "empty": None}
    (tmp_path / "map.tsv").write_text("# ids\nG1\tA\n\nG2\tB\tmore\nalone\nG1\tC\n")
    assert {tuple(r) for r in models.pairs(spark, f"{tmp_path}/map.tsv").collect()} == {("G1", "C"), ("G2", "B")}


def test_json_tables(spark):
    t = spark.createDataFrame([("b", 2), ("a", None)], "x string, y int")
    assert json.loads(models.as_json(t).first()[0]) == {"columns": ["x", "y"], "rows": [["a", ""], ["b", "2"]]}
    assert json.loads(models.as_json(t.limit(0)).first()[0]) == {"columns": ["x", "y"], "rows": []}
    two = models.two_sections("t\tF\nsite\t2.5\n##BETADISPER\nF\tp\n1\t0.2\n")
    assert two == {"permanova": {"columns": ["t", "F"], "rows": [["site", "2.5"]]}, "betadisper": {"columns": ["F", "p"], "rows": [["1", "0.2"]]}}
    assert models.two_sections("")["betadisper"] == {"columns": [], "rows": []}


def test_count_table_with_comments(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("# Constructed from a table\n#OTU ID\ts1\ts.2\nx\t1.0\t0.0\n# x\ny\t\t3\n")
    got = {tuple(r) for r in readers.count_table(spark, f"{tmp_path}/t.tsv", comments=True).collect()}
    assert got == {("x", "s1", 1), ("y", "s.2", 3)}


def test_words_by_micro_batch(spark, tmp_path):
    refs = spark.createDataFrame([(i, "ACGTACGTTG" * 2, f"K;{i % 2}") for i in range(6)], "seq_id long, seq string, lineage string")
    refs.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(refs.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    incremental.append_word_counts(stream, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("word", "lineage").agg({"m": "sum"})
    want = classify.wang_train(refs)[0].select("word", "lineage", "m")
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_shared_table_with_dots(spark, tmp_path):
    (tmp_path / "t.shared").write_text("label\tGroup\tnumOtus\tOtu1\tOtu.2\n0.03\ts1\t2\t4\t0\n0.03\ts2\t2\t0\t5\n")
    got = {(r.feature_id, r["sample"], int(r["count"])) for r in readers.shared(spark, f"{tmp_path}/t.shared").collect()}
    assert got == {("Otu1", "s1", 4), ("Otu.2", "s2", 5)}
