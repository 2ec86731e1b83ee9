from pyspark.sql import functions as F

from adlens.llm import language_id
from adlens.llm.language_id import Scorer, fold, op5_language_id, predict, train


def test_held_out_accuracy(spark, small):
    rows = op5_language_id(spark, "/root/testdata/sf0.01").join(small.select("doc_id", "lang"), "doc_id")
    assert rows.where("held_out and lang = lang_pred").count() >= 0.99 * rows.where("held_out").count()
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0
    assert rows.where((F.col("held_out")) != (fold("doc_id", 4) == 2)).count() == 0


def test_edge_rows(edge, edge_rows, small):
    model = train(small)
    rows = predict(edge, model).collect()
    assert len(rows) == len(edge_rows)
    und = [r for r in rows if r["lang_pred"] == "und"]
    assert len(und) == 4 and all(r["score"] == 0 for r in und)  # two NULLs, one empty, one blank


def test_backoff(small):
    """Unseen words fall back to shorter n-grams; what is remembered of them is bounded."""
    model = train(small)
    scorer = Scorer(model)
    assert scorer.predict("thereation")[0] == "en" and scorer.predict("éauxement")[0] == "fr"
    assert scorer.predict("12 34 !")[0] == "und"
    before, language_id.KEPT_WORDS = language_id.KEPT_WORDS, 1
    try:
        first = scorer.predict("qzthx zzther wherx")
        assert not scorer.unseen and scorer.predict("qzthx zzther wherx") == first
    finally:
        language_id.KEPT_WORDS = before


def test_nothing_to_learn_from(empty, small):
    model = train(empty)
    assert {tuple(r)[1:] for r in predict(small.limit(5), model).collect()} == {("und", 0.0)}
    assert predict(empty, model).collect() == []


def test_a_language_in_few_long_documents(spark):
    """Whatever the draw, one document at least of every language is learned."""
    words = {"xx": "zub kor", "yy": "lim pas"}
    for shift in range(12):
        rows = [(shift * 10 + k, " ".join([words[x]] * 300), x) for k, x in enumerate(("xx", "yy", "yy"))]
        model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_bytes=100)
        assert model.langs == ["xx", "yy"]
        scorer = Scorer(model)
        assert scorer.predict("zub")[0] == "xx" and scorer.predict("pas")[0] == "yy"


def test_very_many_languages(spark):
    """A dirty column: the languages of most text are learned, and the query goes on."""
    rows = [(k, f"w{k} w{k} w{k}", f"l{k}") for k in range(30)] + [(100, "the cat " * 50, "en"), (101, "le chat " * 50, "fr")]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_langs=2)
    assert model.langs == ["en", "fr"]
    assert Scorer(model).predict("the cat")[0] == "en"
