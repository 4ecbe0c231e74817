"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from tripcast.llm import decontaminate, resampling, spelling, topk, warc
from tripcast.llm.language import op5_language
from tripcast.llm.near_duplicates import op9_near_duplicates
from tripcast.llm.packing import op10_packing
from tripcast.llm.pii import op7_pii
from tripcast.llm.quality import op1_quality
from tripcast.llm.quality_rules import op13_quality_rules
from tripcast.llm.sharding import op3_sharding
from tripcast.llm.substrings import op4_substrings

QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_sharding": op3_sharding,
    "op4_substrings": op4_substrings,
    "op5_language": op5_language,
    "op6_topk": topk.op6_topk,
    "op7_pii": op7_pii,
    "op8_warc": warc.op8_warc,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_packing": op10_packing,
    "op11_spelling": spelling.op11_spelling,
    "op12_resampling": resampling.op12_resampling,
    "op13_quality_rules": op13_quality_rules,
}
ORACLES: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op6_topk": topk.ORACLE,
    "op8_warc": warc.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op12_resampling": resampling.ORACLE,
}


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict:
    return dict(ORACLES)
