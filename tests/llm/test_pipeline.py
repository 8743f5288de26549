import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotewell.llm import decontamination, secrets, toxicity
from quotewell.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.samples import docs_of, odd_texts, prose
from tests.llm.test_jaccard import edited


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of each fate, with labels and a benchmark."""
    root = tmp_path_factory.mktemp("sf")
    item = prose(900, 40)
    rows = [(k, prose(k, 60)) for k in range(60)]
    rows += [(100 + k, prose(200 + k, 50) + " you moron. moron!") for k in range(20)]
    rows += [(200, edited(prose(1, 60), 1, 1)), (201, prose(2, 60)), (201, prose(2, 60)), (300, prose(301, 30) + "\n" + item + "\n" + prose(302, 30))]
    rows += [(400, prose(401, 30) + " token = abcdef123456 " + prose(402, 20)), (500, None), (501, ""), (None, prose(501, 60))]
    docs_of(spark, rows).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(i, int(100 <= i < 120)) for i, _ in rows if i is not None and i != 201], "doc_id long, toxic int").write.parquet(str(root / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        seen.append((name, docs))
        if name != "packing":
            docs = secrets.stored(docs, "stage")
            assert docs.columns == seen[0][1].columns
    ids = [sorted(str(r["doc_id"]) for r in d.select("doc_id").collect()) for _, d in seen]
    toxic = {str(100 + k) for k in range(20)}
    assert not toxic & set(ids[0]) and len(ids[0]) == 68
    assert set(ids[0]) - set(ids[1]) == {"200", "201"} and len(ids[1]) == 65  # of 2 and two rows of 201 one stays
    assert set(ids[1]) - set(ids[2]) == {"300"}
    assert ids[3] == ids[2]
    text = {r["doc_id"]: r["text"] for r in seen[3][1].collect()}
    assert "[secret]" in text[400] and "abcdef123456" not in text[400] and text[5] == prose(5, 60)
    packed = corpus_pipeline.run(spark, folder)
    assert {str(r["doc_id"]) for r in packed.select("doc_id").distinct().collect()} == set(ids[3])


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert toxicity and decontamination


def run_stages(spark, docs, folder):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs = docs if name == "packing" else secrets.stored(docs, "stage")
        out[name] = docs
    return out


def odd_folder(spark, root, rows, labels, items, id_type="long"):
    """Documents with a dotted column and a map, and the tables that the stages read."""
    docs = docs_of(spark, rows).withColumn("doc_id", F.col("doc_id").cast(id_type)).withColumn("a.b", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), "uid"))
    spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("doc_id", F.col("doc_id").cast(id_type)).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return docs


def test_without_labels_nothing_is_toxic(spark, tmp_path):
    rows = [(k, prose(k, 40) + (" you moron" if k % 2 else "")) for k in range(8)]
    for n, labels in enumerate(([], [(0, 0), (1, 1), (2, 0), (3, 1)], [(k, 1) for k in range(8)], [(k, 0) for k in range(8)])):
        root = str(tmp_path / str(n))
        docs = odd_folder(spark, root, rows, labels, [])
        assert corpus_pipeline.drop_toxic(spark, docs, root).count() == 8


@pytest.mark.parametrize("names", [lambda k: f"{k:03d}", lambda k: f"id-{k}"])
def test_text_ids_go_through_every_stage(spark, tmp_path, names):
    item = prose(900, 40)
    texts = [prose(k, 60) + f" password = hunter{k}secret " + prose(50 + k, 20) for k in range(6)] + [prose(2, 60) + " password = hunter2secret " + prose(52, 20)]
    texts += [prose(80, 30) + " " + item, None, ""]
    docs = odd_folder(spark, str(tmp_path), list(enumerate(texts)), [], [(1, item)])
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    docs = docs.withColumn("doc_id", F.element_at(F.create_map(*[F.lit(x) for k in range(10) for x in (str(k), names(k))]), F.col("doc_id")))
    out = run_stages(spark, docs, str(tmp_path))
    kept = {r["doc_id"]: r["text"] for r in out["secrets"].collect()}
    assert len(kept) == 8 and names(7) not in kept and len({names(2), names(6)} & set(kept)) == 1
    assert not any("hunter" in (t or "") for t in kept.values()) and sum("[secret]" in (t or "") for t in kept.values()) == 6
    assert out["secrets"].columns == docs.columns
    assert out["packing"].select("doc_id").distinct().count() == 8


def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path):
    docs = odd_folder(spark, str(tmp_path), odd_texts(), [(1, 0), (None, 1)], [(1, None), (2, "")])
    out = run_stages(spark, docs, str(tmp_path))
    assert out["toxicity"].count() == len(odd_texts())
    ids = sorted(str(r["doc_id"]) for r in out["near_duplicates"].collect())
    assert {"3", "4", "5", "8", "None"} <= set(ids) and ids.count("2") + ids.count("1") == 1
    long = out["secrets"].where("doc_id = 8").first()
    assert long["text"] == prose(3, 30_000) and long["a.b"] == 1 and long["m"] == {"k": 2}
    assert {n: df.count() for n, df in run_stages(spark, docs.where("false"), str(tmp_path)).items()} == dict.fromkeys(out, 0)
