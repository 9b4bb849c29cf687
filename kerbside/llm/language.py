"""Language identification by compression.

A text belongs to the language whose raw-content zstandard dictionary
compresses it to the fewest bytes. Dictionaries are raw text of labelled
documents: letters in lower case, words parted by single spaces. A text is
compressed in blocks, so that its own repetitions do not hide the dictionary.

Labels are noisy, so dictionaries are made twice: those of one half of the
sample judge the other half, and only texts that keep their label go into the
final dictionaries.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and is rejected; with no labelled text at all every document is ``und``. Ties
go to the most frequent label. Narrow margins are rejected, except in texts of
fewer than ``short`` bytes, whose sizes are too coarse to have a margin: those
are kept with the best language. Equal texts get equal answers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.llm import common

UNKNOWN = "und"
SLACK, SHARED = 4, 8
# ASCII bytes other than letters part words; bytes of other scripts stay.
LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
VERDICT = "struct<lang:string,score:double,margin:double,accepted:boolean>"


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS).split())


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language, the most frequent first; at most ``dictionary_bytes`` each."""

    dictionaries: dict[str, bytes]
    level: int = 5
    block: int = 512
    narrow: float = 0.01  # smallest accepted (second - best) / second
    short: int = 64

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for content in self.dictionaries.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary))
        return made


def sizes(text: bytes, compressors: list, block: int) -> list[int]:
    """Compressed bytes under each dictionary."""
    blocks = [text[i : i + block] for i in range(0, len(text), block)]
    return [sum(len(c.compress(part)) for part in blocks) for c in compressors]


def judge(text: str | None, languages: list[str], compressors: list, model: LanguageModel) -> dict:
    content = normal(text or "")
    if not languages or not any(map(str.isalpha, text or "")):
        return {"lang": UNKNOWN, "score": 0.0, "margin": 0.0, "accepted": False}
    found = np.array(sizes(content, compressors, model.block), dtype=np.float64)
    best = int(found.argmin())
    others = np.delete(found, best)
    margin = float((others.min() - found[best]) / others.min()) if len(others) else 1.0
    score = float(1.0 / np.exp2(np.maximum(found[best] - found, -60.0)).sum())
    return {"lang": languages[best], "score": score, "margin": margin, "accepted": margin >= model.narrow or len(content) < model.short}


def _dictionary(texts: list[bytes], limit: int) -> bytes:
    return b"\n".join(texts)[-limit:]


def _cleaned(samples: dict[str, list[bytes]], limit: int, level: int, block: int) -> dict[str, list[bytes]]:
    """The samples that the other half's dictionaries assign to their own label."""
    languages = sorted(samples)
    halves = [{lang: samples[lang][k::2] for lang in languages} for k in (0, 1)]
    kept: dict[str, list[bytes]] = {lang: [] for lang in languages}
    for own, other in ((0, 1), (1, 0)):
        model = LanguageModel({lang: _dictionary(halves[other][lang], limit) for lang in languages}, level, block)
        compressors = model.compressors()
        for at, lang in enumerate(languages):
            kept[lang] += [x for x in halves[own][lang] if int(np.argmin(sizes(x, compressors, block))) == at]
    return {lang: kept[lang] or samples[lang] for lang in languages}


def learn(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    *,
    documents_per_language: int = 400,
    sample_chars: int = 1024,
    dictionary_bytes: int = 65536,
    max_languages: int = 500,
    level: int = 5,
    block: int = 512,
    narrow: float = 0.01,
) -> LanguageModel:
    """Dictionaries from a bounded sample of labelled rows.

    The bound: at most ``documents_per_language`` times ``max_languages`` texts
    of ``sample_chars`` characters are used, and no more than ``SLACK`` times as
    many leave the executors. With more languages than ``max_languages`` each
    gets a smaller part of the same whole, so that all have a dictionary; only
    labels beyond ``SHARED`` times ``max_languages`` are left out, the least
    frequent first. The sample follows a hash of the text, so it depends neither
    on the layout nor on ids, and equal texts of a language count once.
    """
    known = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(label).alias("l"), F.substring(text, 1, sample_chars).alias("t")
    )
    placed = known.withColumn("p", F.xxhash64("t"))
    counts = (
        placed.groupBy("l")
        .agg(F.count("*").alias("n"), F.approx_count_distinct("p").alias("texts"))
        .orderBy(F.desc("n"), "l")
        .limit(SHARED * max_languages)
        .collect()
    )
    if not counts:
        return LanguageModel({}, level, block, narrow)
    if len(counts) > max_languages:
        documents_per_language = max(1, documents_per_language * max_languages // len(counts))
        dictionary_bytes = max(1, dictionary_bytes * max_languages // len(counts))
    # a hash below the share keeps about twice the texts asked for, most of which are then used
    shares = [(row["l"], min(1.0, 2.0 * documents_per_language / row["texts"])) for row in counts]
    spark = labelled.sparkSession
    few = spark.createDataFrame(shares, "l string, share double")
    place = F.pmod(F.col("p"), F.lit(1 << 40)) / float(1 << 40)
    # tasks add up equal texts before anything moves, so what one language has to order is its share
    chosen = (
        placed.join(F.broadcast(few), "l").where(place < F.col("share")).groupBy("l", "p").agg(F.min("t").alias("t"))
    )
    order = F.row_number().over(W.partitionBy("l").orderBy(place, "p"))
    rows = chosen.select("l", "t", place.alias("p"), order.alias("k")).where(F.col("k") <= SLACK * documents_per_language).collect()
    samples: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["l"], r["p"], r["t"])):
        mine = samples.setdefault(row["l"], [])
        content = normal(row["t"])
        if content and len(mine) < documents_per_language and content not in mine:
            mine.append(content)
    clean = _cleaned({k: v for k, v in samples.items() if v}, dictionary_bytes, level, block)
    number = {row["l"]: row["n"] for row in counts}
    order = sorted(clean, key=lambda lang: (-number[lang], lang))
    return LanguageModel({k: _dictionary(clean[k], dictionary_bytes) for k in order}, level, block, narrow)


def verdicts(spark: SparkSession, model: LanguageModel):
    """A column function: text to (lang, score, margin, accepted).

    The model is broadcast; its size is bounded by languages times dictionary bytes.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(VERDICT)
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        languages, compressors = list(own.dictionaries), own.compressors()
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("accepted", pa.bool_())])
        for batch in batches:
            yield pa.array([judge(text.as_py(), languages, compressors, own) for text in batch], kind)

    return identify


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from documents outside fold 0 of 5."""
    documents = common.table(spark, folder, "documents")
    model = learn(documents.where(common.fold(5) != 0))
    verdict = verdicts(spark, model)(F.col("text"))
    return documents.select(
        "doc_id",
        F.coalesce(common.fold(5) == 0, F.lit(True)).alias("held_out"),
        verdict.alias("v"),
    ).select(
        "doc_id",
        "held_out",
        F.col("v.lang").alias("lang_pred"),
        F.col("v.score").alias("score"),
        F.col("v.margin").alias("margin"),
        F.col("v.accepted").alias("accepted"),
    )
