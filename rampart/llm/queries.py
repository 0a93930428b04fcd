"""Queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from rampart.llm.decontam import op9
from rampart.llm.divergence import OP12_SQL, op12
from rampart.llm.filter_audit import OP13_SQL, op13
from rampart.llm.html_text import op10
from rampart.llm.lm import op3
from rampart.llm.near_dup import OP7_SQL, op7
from rampart.llm.packing import op4
from rampart.llm.quality import op8
from rampart.llm.sharding import op11
from rampart.llm.store import shipped
from rampart.llm.substring import OP1_SQL, op1
from rampart.llm.tokens import op2
from rampart.llm.topk import OP5_SQL, op5
from rampart.llm.toxicity import op6

QUERIES = {name: shipped(plan) for name, plan in {
    "op1_substring_dedup": op1,
    "op2_token_counts": op2,
    "op3_lm_scores": op3,
    "op4_packing": op4,
    "op5_exact_top_k": op5,
    "op6_toxicity": op6,
    "op7_near_dup": op7,
    "op8_quality": op8,
    "op9_decontamination": op9,
    "op10_html_text": op10,
    "op11_sharding": op11,
    "op12_source_divergence": op12,
    "op13_filter_audit": op13,
}.items()}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op5_exact_top_k": OP5_SQL,
    "op7_near_dup": OP7_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
