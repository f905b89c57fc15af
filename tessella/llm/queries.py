"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from tessella.llm import jaccard, language, licenses, line_dedup, mixing, packing, pii, toxicity, vectors
from tessella.llm.common import read


def _on(table: str, f):
    return lambda spark, sf_dir: f(read(spark, sf_dir, table))


def queries() -> dict:
    return {
        "op1_line_dedup": _on("documents", line_dedup.op1_line_dedup),
        "op2_pii": _on("documents", pii.op2_pii),
        "op3_toxicity": lambda spark, sf_dir: toxicity.op3_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
        "op4_permutation_ann": _on("embeddings", vectors.permutation_top),
        "op5_packing": _on("documents", packing.op5_packing),
        "op6_language_id": _on("documents", language.op6_language_id),
        "op7_mixing": _on("documents", mixing.op7_mixing),
        "op8_exact_topk": _on("embeddings", vectors.exact_top),
        "op9_license_scan": _on("documents", licenses.op9_license_scan),
        "op10_jaccard_join": _on("documents", jaccard.op10_jaccard_join),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.OP1_SQL, "op7_mixing": mixing.OP7_SQL, "op8_exact_topk": vectors.OP8_SQL, "op9_license_scan": licenses.OP9_SQL}
