"""Queries of the numbered operators, with their oracle SQL."""

from __future__ import annotations

from judgeset.llm.chat import OP6_SQL, op6_chat_formatting
from judgeset.llm.embedding_join import op3_embedding_join
from judgeset.llm.jaccard_join import op9_jaccard_join
from judgeset.llm.lexical_search import OP12_SQL, op12_lexical_search
from judgeset.llm.line_dedup import OP2_SQL, op2_line_dedup
from judgeset.llm.mixing import OP7_SQL, op7_mixing
from judgeset.llm.packing import op4_best_fit_packing
from judgeset.llm.pii import OP11_SQL, op11_pii
from judgeset.llm.quality_classifier import op10_quality_classifier
from judgeset.llm.quality_rules import op1_quality_rules
from judgeset.llm.spelling import op13_spelling_variants
from judgeset.llm.suffix_dedup import op5_suffix_dedup
from judgeset.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_embedding_join": op3_embedding_join,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_pii": op11_pii,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLES = {
    "op2_line_dedup": OP2_SQL,
    "op6_chat_formatting": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op11_pii": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}
