"""The registered queries of the llm operators: each over its whole table, with production parameters."""

from __future__ import annotations

from daycast.llm import chat, line_dedup, substring_dedup
from daycast.llm.bpe import op9_bpe
from daycast.llm.brown_lm import op6_brown_lm
from daycast.llm.decontaminate import op5_decontaminate
from daycast.llm.fingerprints import op10_fingerprints
from daycast.llm.langid import op7_language
from daycast.llm.minhash import op2_near_dedup
from daycast.llm.runs import op12_runs
from daycast.llm.secrets import op8_secrets
from daycast.llm.spelling import op11_spelling
from daycast.llm.token_counts import op4_token_counts

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_decontaminate": op5_decontaminate,
    "op6_brown_lm": op6_brown_lm,
    "op7_language": op7_language,
    "op8_secrets": op8_secrets,
    "op9_bpe": op9_bpe,
    "op10_fingerprints": op10_fingerprints,
    "op11_spelling": op11_spelling,
    "op12_runs": op12_runs,
    "op13_chat": chat.op13_chat,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op3_substring_dedup": substring_dedup.ORACLE_SQL,
    "op13_chat": chat.ORACLE_SQL,
}
