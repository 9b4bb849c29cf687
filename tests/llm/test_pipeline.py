"""The stages against the operators' own answers."""

import importlib.util
import pathlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbside.llm import personal, simhash

FOLDER = "/root/testdata/sf0.001"
PATH = pathlib.Path(__file__).parents[2] / "corpus_pipeline.py"


@pytest.fixture(scope="module")
def pipeline():
    spec = importlib.util.spec_from_file_location("corpus_pipeline", PATH)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_stages_one_after_the_other(spark, pipeline, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumns({"fp": F.lit("x"), "d2": F.lit(1), "id": F.lit(2), "row": F.lit(3), "g": F.lit(4)})
    labels = {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    names, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == names
        after = {r["doc_id"]: r for r in docs.collect()}
        assert len(after) == docs.count() and set(after) <= set(before)
        if name == "near_duplicates":
            rows = spark.createDataFrame([(i, simhash.fingerprint(r["text"].encode())) for i, r in before.items()], "doc_id long, fp long")
            assert set(after) == {r["component_id"] for r in simhash.classes(rows).collect()}
        elif name == "personal":
            automaton = personal._automaton()
            assert set(after) == set(before)
            for key, row in before.items():
                found = personal.find(row["text"], automaton)
                assert (after[key]["text"] == row["text"]) == (not found)
                assert after[key]["n_chars"] == len(after[key]["text"])
                assert not any(k == "email" for k, *_ in personal.find(after[key]["text"], automaton))
        else:
            assert all(after[i] == before[i] for i in after)
            good = [i for i, r in before.items() if labels.get(i, {}).get("quality") == 1 and len(r["text"].split()) >= 50]
            assert sum(i in after for i in good) >= 0.98 * len(good)
        before = after
    pieces = pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"] for r in pieces.collect()} == set(before)


def test_odd_rows(spark, pipeline, tmp_path):
    text = "Some ordinary words that make a sentence about the weather and the sea, " * 2
    words = text + " ".join(f"number{i} and other{i * 7 % 13} things{i}" for i in range(40))
    rows = [(None, words, "en", "a", 5), (1, words, "en", None, 5), (1, words, "en", None, 5), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "12 34", "en", "a", 5)]
    rows += [(9, "Otras palabras de una lengua distinta y la casa de mi tío. " + " ".join(f"cosa{i} y otra{i} más{i}" for i in range(40)), "es", "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in pipeline.STAGES:
            path = str(tmp_path / f"{empty}-{name}")
            stage(spark, now, FOLDER).write.parquet(path)
            now = spark.read.parquet(path)
        assert now.count() == (0 if empty else 2)


def test_near_duplicates_send_no_exploded_table_to_the_driver(spark, pipeline, monkeypatch):
    """Half a gigabyte of documents is a small file of fingerprints, and 35 rows of each to join."""
    plans, plain = [], simhash.links

    def kept(*given):
        found = plain(*given)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(simhash, "links", kept)
    docs = spark.createDataFrame([(i, f"some words of text {i} and {i * 7} more") for i in range(50)], "doc_id long, text string")
    assert 0 < pipeline.near_duplicate_stage(spark, docs, FOLDER).count() <= 50
    assert len(plans) == 1 and "SortMergeJoin" in plans[0]
    assert "BroadcastHashJoin" not in plans[0]
