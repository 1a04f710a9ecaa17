"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .conversation_trie import op11_conversation_trie
from .decontamination import OP3_SQL, op3_decontamination
from .katz import op2_katz_scoring
from .language_id import op10_language_id
from .line_dedup import OP4_SQL, op4_line_dedup
from .minhash_tensor import op13_minhash_tensor
from .packing import op9_best_fit_packing
from .pii import op5_pii
from .quality_cotraining import op7_quality_cotraining
from .quality_rules import op8_quality_rules
from .simhash_golay import op6_simhash_golay
from .spelling_variants import op12_spelling_variants
from .toxicity import op1_toxicity


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_katz_scoring": op2_katz_scoring,
        "op3_decontamination": op3_decontamination,
        "op4_line_dedup": op4_line_dedup,
        "op5_pii": op5_pii,
        "op6_simhash_golay": op6_simhash_golay,
        "op7_quality_cotraining": op7_quality_cotraining,
        "op8_quality_rules": op8_quality_rules,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_language_id": op10_language_id,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_minhash_tensor": op13_minhash_tensor,
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3_SQL, "op4_line_dedup": OP4_SQL}
