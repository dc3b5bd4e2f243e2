"""The registered corpus queries."""

from __future__ import annotations

from .ann import OP4_SQL, op4_ann
from .bpe import op3_bpe
from .chat import OP6_SQL, op6_chat
from .decontaminate import OP10_SQL, op10_decontaminate
from .html_extract import op7_html
from .lexical_search import OP11_SQL, op11_lexical
from .lm_score import op5_lm_score
from .near_dedup import OP9_SQL, op9_near_dedup
from .pii import OP1_SQL, op1_pii
from .pipeline import run as pipeline
from .quality import op2_quality
from .quality_rules import op12_quality_rules
from .substring_dedup import op8_substring_dedup
from .whitening import op13_whiten


def queries() -> dict:
    return {
        "op1_pii": op1_pii,
        "op2_quality": op2_quality,
        "op3_bpe": op3_bpe,
        "op4_ann": op4_ann,
        "op5_lm_score": op5_lm_score,
        "op6_chat": op6_chat,
        "op7_html": op7_html,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_near_dedup": op9_near_dedup,
        "op10_decontaminate": op10_decontaminate,
        "op11_lexical": op11_lexical,
        "op12_quality_rules": op12_quality_rules,
        "op13_whiten": op13_whiten,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_pii": OP1_SQL, "op4_ann": OP4_SQL, "op6_chat": OP6_SQL, "op9_near_dedup": OP9_SQL, "op10_decontaminate": OP10_SQL, "op11_lexical": OP11_SQL}
