"""Accuracy on held-out documents, and odd input."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from kerbside.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    labels = {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    found = language.op8_language(spark, FOLDER).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r["held_out"] and len(rows[r["doc_id"]]["text"]) >= 100]
    assert sum(r["lang_pred"] == rows[r["doc_id"]]["lang"] for r in held) >= 0.95 * len(held)
    good = [r for r in found if labels.get(r["doc_id"], {}).get("quality") == 1]
    assert sum(r["accepted"] for r in good) >= 0.995 * len(good)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_sources_and_ids_are_no_input(spark):
    texts = ["the quick brown fox and the lazy dog " * 4, "la casa de la tia y el perro " * 4]
    model = language.LanguageModel({"en": texts[0].encode(), "es": texts[1].encode()})
    identify = language.verdicts(spark, model)
    rows = [(i, t, lang, s) for i, t in enumerate(texts) for lang in ("en", "xx", None) for s in ("a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = frame.select("doc_id", identify(F.col("text")).alias("v")).distinct().collect()
    assert sorted((r["doc_id"], r["v"]["lang"]) for r in out) == [(0, "en"), (1, "es")]


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "12 # 34"), (4, "été"), (5, "word " * 60_000), (5, "word " * 60_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame([(i, f"some english words {i} here", "en") for i in range(9)] + [(9, None, "fr"), (10, "x", None)], "doc_id long, text string, lang string")
    identify = language.verdicts(spark, language.learn(labelled))
    out = [r["v"] for r in frame.select(identify(F.col("text")).alias("v")).collect()]
    assert [v["lang"] for v in out] == ["und", "und", "und", "en", "en", "en"]
    assert [v["accepted"] for v in out] == [False, False, False, True, True, True]
    assert out[4] == out[5]
    none = language.verdicts(spark, language.learn(labelled.limit(0)))
    assert {r["v"]["lang"] for r in frame.select(none(F.col("text")).alias("v")).collect()} == {"und"}
    assert frame.limit(0).select(identify(F.col("text"))).collect() == []


def test_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    taken = []
    cleaned = language._cleaned
    collect = type(spark.range(1)).collect

    def counted(frame):
        out = collect(frame)
        taken.append(len(out))
        return out

    monkeypatch.setattr(type(spark.range(1)), "collect", counted)
    monkeypatch.setattr(language, "_cleaned", lambda samples, *rest: taken.append({k: len(v) for k, v in samples.items()}) or cleaned(samples, *rest))
    frame = spark.range(20_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN CAST(NULL AS BIGINT) WHEN id % 4 = 1 THEN 7 ELSE id END AS doc_id",
        "concat('text ', translate(CAST(id AS STRING), '0123456789', 'abcdefghij'), if(id % 3 = 0, ' the and', ' el y')) AS text",
        "if(id % 3 = 0, 'en', 'es') AS lang",
    )
    # most rows of one language are one text
    frame = frame.union(spark.range(20_000).selectExpr("CAST(NULL AS BIGINT)", "'one text of many'", "'en'"))
    model = language.learn(frame, documents_per_language=50)
    assert taken[1] <= 2 * language.SLACK * 50
    assert taken[2] == {"en": 50, "es": 50}
    assert list(model.dictionaries) == ["en", "es"]


def test_many_languages_share_the_whole(spark):
    frame = spark.range(180).selectExpr("id AS doc_id", "concat('w', translate(CAST(id AS STRING), '0123456789', 'abcdefghij'), ' x y') AS text", "concat('l', id % 30) AS lang")
    model = language.learn(frame, max_languages=10, documents_per_language=12, dictionary_bytes=3000)
    assert len(model.dictionaries) == 30
    assert all(0 < len(content) <= 1000 for content in model.dictionaries.values())
