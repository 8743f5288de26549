import zlib

import pytest
from pyspark.sql import functions as F

from quotewell.llm import language
from quotewell.llm.queries import op11_compression_language
from tests.llm.samples import docs_of, odd_texts

NAMES = ("#language", "#score", "#rejected")


def test_held_out_accuracy(spark):
    """Learnt without the fold it is measured on; junk of a few letters is in the table as well."""
    sf_dir = "/root/testdata/sf0.01"
    out = op11_compression_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held_out = out["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    assert len(out) == 1000 and (out["held_out"] == held_out).all()
    right = out["lang"] == out["lang_pred"]
    assert right[held_out].mean() > 0.985
    assert right[held_out & ~out["rejected"]].mean() > 0.995
    assert out["score"].between(0, 1).all()


def toy(spark):
    rows = [("en", "the quick brown fox jumps over the lazy dog " * 3 + str(k)) for k in range(20)]
    rows += [("de", "der schnelle braune fuchs springt über den faulen hund " * 3 + str(k)) for k in range(20)]
    return spark.createDataFrame([*rows, (None, "the dog"), ("fr", None)], "lang string, text string")


def test_odd_rows(spark):
    model = language.learn(toy(spark))
    assert sorted(model.contents) == ["de", "en"]
    rows = odd_texts() + [(20, "123 !!"), (21, "The lazy dog jumps over the brown fox"), (22, "Den FAULEN Hund über"), (23, "²½")]
    out = {}
    for r in language.identify(docs_of(spark, rows), model, NAMES).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert len(out[2]) == 2 and out[2][0]["#language"] == out[2][1]["#language"] == out[1][0]["#language"]
    for i in (3, 4, 5, 20, 23):
        assert (out[i][0]["#language"], out[i][0]["#score"], out[i][0]["#rejected"]) == ("und", 0.0, True)
    assert (out[21][0]["#language"], out[22][0]["#language"]) == ("en", "de") and not out[21][0]["#rejected"]
    assert out[10][0]["#language"] in ("de", "en") and out[8][0]["#score"] <= 1
    assert language.identify(docs_of(spark, []), model, NAMES).count() == 0


def test_nothing_learnt_and_ties(spark):
    docs = docs_of(spark, [(1, "the dog"), (2, None)])
    empty = language.learn(toy(spark).where("lang = 'xx'"))
    assert {(r["#language"], r["#score"]) for r in language.identify(docs, empty, NAMES).collect()} == {("und", 0.0)}
    same = spark.createDataFrame([("b", "some words here"), ("b", "some words here"), ("a", "some words here")], "lang string, text string")
    r = language.identify(docs, language.learn(same), NAMES).first()
    assert (r["#language"], r["#score"], r["#rejected"]) == ("b", 0.5, True)


@pytest.mark.parametrize("pieces", [3, 40])
def test_dictionary_is_a_sample_of_bounded_size(spark, pieces):
    rows = toy(spark).withColumn("text", F.concat_ws(" ", *["text"] * 30))
    for content in language.learn(rows.repartition(5), pieces).contents.values():
        assert len(content.decode()) <= pieces * (language.PIECE + 1)
