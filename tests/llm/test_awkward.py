"""Every stage on awkward rows: nulls, empty and long texts, repeated rows, dotted and clashing column names, an empty table."""

import pytest

import corpus_pipeline
from brackish.llm import decontam, line_dedup, mixing, simhash, toxicity

SCHEMA = "doc_id long, text string, source string, `a.b` string, _clean string, rejected string, MIX_COPY int, k_id long, `row` string, `line` string"
ITEM = "the quick brown fox jumps over the lazy dog near the old stone bridge"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, None), (None, "no id here at all"), (4, "plain words stay as they are"), (4, "plain words stay as they are"), (5, "x " + ITEM + " y"), (6, "long " * 50_000), (7, ITEM.replace("jumps", "jumpz") + " tail")]
    return spark.createDataFrame([(i, t, "s", "ab", "c", "r", 9, 8, "w", "l") for i, t in rows], SCHEMA)


def stages(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (1, ITEM)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (4, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")

    def toxic(docs):
        return toxicity.graded(docs, toxicity.train(docs, labels)).where("not rejected").select("row.*")

    return {"toxicity": toxic, "lines": line_dedup.dedup, "near": simhash.keep_similar, "one": simhash.keep_one, "leaks": lambda d: decontam.clean(d, bench), "mix": mixing.mix}


@pytest.mark.parametrize("name", ["toxicity", "lines", "near", "one", "leaks", "mix"])
def test_stage(spark, docs, name):
    stage = stages(spark)[name]
    out = stage(docs)
    names = [c for c in docs.columns if name != "mix" or c != "MIX_COPY"]
    assert out.columns[: len(names)] == names
    rows = [r.asDict() for r in out.collect()]
    assert all(r["rejected"] == "r" and r["a.b"] == "ab" and r["_clean"] == "c" for r in rows)
    ids = sorted((r["doc_id"] for r in rows), key=str)
    want = {"toxicity": [1, 2, 3, 4, 4, 5, 6, 7, None, None], "lines": [1, 2, 3, 4, 4, 5, 6, 7, None, None], "near": [1, 4, 5, 6, 7, None], "leaks": [1, 2, 3, 4, 4, 6, None, None]}.get(name)
    assert want is None or ids == want
    assert stage(docs.limit(0)).count() == 0


def test_composition(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= {1, 4, 6, None} and {4, 6} <= {r["doc_id"] for r in out}
