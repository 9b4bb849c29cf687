"""The registered queries of this package and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import alignment, bpe, jaccard, language, layout, maxent, minhash, packing, personal, phrases, quality, simhash, transducer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal": personal.op1_personal,
    "op2_quality": quality.op2_quality,
    "op3_minhash": minhash.op3_minhash,
    "op4_simhash": simhash.op4_simhash,
    "op5_maxent": maxent.op5_maxent,
    "op6_packing": packing.op6_packing,
    "op7_bpe": bpe.op7_bpe,
    "op8_language": language.op8_language,
    "op9_tokens": transducer.op9_tokens,
    "op10_layout": layout.op10_layout,
    "op11_phrases": phrases.op11_phrases,
    "op12_jaccard": jaccard.op12_jaccard,
    "op13_alignment": alignment.op13_alignment,
}
ORACLES: dict[str, str] = {"op11_phrases": phrases.OP11_SQL, "op12_jaccard": jaccard.OP12_SQL}
