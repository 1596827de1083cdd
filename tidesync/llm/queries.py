"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, divergence, fim, rules, substrings
from .bpe import op1_byte_bpe
from .chat import op6_chat
from .divergence import op11_source_audit
from .fim import op13_fill_in_middle
from .jaccard import op12_ngram_jaccard
from .mixing import op4_mixing
from .neighbours import op8_neighbours
from .pii import op9_personal_data
from .quality import op3_quality
from .rules import op7_quality_rules
from .simhash import op2_simhash
from .substrings import op10_substrings
from .urls import op5_url_filters

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_url_filters": op5_url_filters,
    "op6_chat": op6_chat,
    "op7_quality_rules": op7_quality_rules,
    "op8_neighbours": op8_neighbours,
    "op9_personal_data": op9_personal_data,
    "op10_substrings": op10_substrings,
    "op11_source_audit": op11_source_audit,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op6_chat": chat.ORACLE_SQL,
    "op7_quality_rules": rules.ORACLE_SQL,
    "op10_substrings": substrings.ORACLE_SQL,
    "op11_source_audit": divergence.ORACLE_SQL,
    "op13_fill_in_middle": fim.ORACLE_SQL,
}
