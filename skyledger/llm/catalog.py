"""The queries of this package by name, and the SQL of those that SQL can express."""

from skyledger.llm import (
    collocations, decontaminate, exact_dedup, hard_negatives, language, near_dedup, packing, quality, reply_trees, secrets, substring_dedup,
    toxicity, warc,
)

QUERIES = {
    "op1_packing": packing.query,
    "op2_warc": warc.query,
    "op3_substring_dedup": substring_dedup.query,
    "op4_decontaminate": decontaminate.query,
    "op5_secrets": secrets.query,
    "op6_language": language.query,
    "op7_near_dedup": near_dedup.query,
    "op8_toxicity": toxicity.query,
    "op9_quality": quality.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_chat_formatting": reply_trees.query,
    "op13_collocations": collocations.query,
}

ORACLE_SQL = {
    "op2_warc": warc.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_chat_formatting": reply_trees.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
