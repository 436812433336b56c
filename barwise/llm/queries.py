"""The registered queries of the operators and their DuckDB twins."""

from __future__ import annotations

from .language import op10_language
from .licenses import op7_licenses
from .minhash import op3_minhash
from .negatives import OP12_SQL, op12_negatives
from .packing import op4_best_fit_packing
from .pii import op2_pii
from .quality import op6_quality
from .quality_rules import op13_quality_rules
from .resampling import op11_resampling
from .substring import op1_sentence_spans
from .suffix import op8_decontamination
from .token_files import op5_token_files
from .topk import OP9_SQL, op9_topk

QUERIES = {
    "op1_sentence_spans": op1_sentence_spans,
    "op2_pii": op2_pii,
    "op3_minhash": op3_minhash,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_decontamination": op8_decontamination,
    "op9_topk": op9_topk,
    "op10_language": op10_language,
    "op11_resampling": op11_resampling,
    "op12_negatives": op12_negatives,
    "op13_quality_rules": op13_quality_rules,
}

SQL = {
    "op9_topk": OP9_SQL,
    "op12_negatives": OP12_SQL,
}
