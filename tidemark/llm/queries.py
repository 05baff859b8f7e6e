"""The thirteen queries of the pipeline operators, and the SQL of those that SQL expresses."""

from __future__ import annotations

from tidemark.llm import chat, decontam, divergence, quality, substring
from tidemark.llm.chat import op1_chat_tool_links
from tidemark.llm.decontam import op2_decontamination
from tidemark.llm.divergence import op11_source_divergence
from tidemark.llm.extraction import op7_html_text
from tidemark.llm.licenses import op6_license_scan
from tidemark.llm.packing import op8_packing
from tidemark.llm.periodicruns import op12_periodic_runs
from tidemark.llm.quality import op5_quality_rules
from tidemark.llm.sharding import op3_sharding
from tidemark.llm.simhash import op10_simhash
from tidemark.llm.substring import op4_substring_dedup
from tidemark.llm.tokencounts import op13_token_counts
from tidemark.llm.toxicity import op9_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_tool_links, op2_decontamination, op3_sharding, op4_substring_dedup, op5_quality_rules,
        op6_license_scan, op7_html_text, op8_packing, op9_toxicity, op10_simhash,
        op11_source_divergence, op12_periodic_runs, op13_token_counts,
    )
}

ORACLES = {"op1_chat_tool_links": chat.ORACLE, "op2_decontamination": decontam.ORACLE, "op4_substring_dedup": substring.ORACLE, "op5_quality_rules": quality.ORACLE, "op11_source_divergence": divergence.ORACLE}
