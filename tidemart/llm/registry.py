"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tidemart.llm.byte_bpe import op8_byte_bpe
from tidemart.llm.conversation_repair import SQL as REPAIR_SQL
from tidemart.llm.conversation_repair import op12_conversation_repair
from tidemart.llm.decontaminate import op7_decontamination
from tidemart.llm.near_dedup import op3_minhash_near_dedup
from tidemart.llm.periodic_runs import op11_periodic_runs
from tidemart.llm.pii import op10_pii
from tidemart.llm.quality_classifier import op6_quality_classifier
from tidemart.llm.quality_rules import op5_quality_rules
from tidemart.llm.secrets import op4_secret_scan
from tidemart.llm.source_mix import SQL as MIX_SQL
from tidemart.llm.source_mix import op13_source_mix
from tidemart.llm.substring_dedup import op2_substring_dedup
from tidemart.llm.toxicity import op1_toxicity
from tidemart.llm.warc import SQL as WARC_SQL
from tidemart.llm.warc import op9_warc

QUERIES = {f.__name__: f for f in (
    op1_toxicity,
    op2_substring_dedup,
    op3_minhash_near_dedup,
    op4_secret_scan,
    op5_quality_rules,
    op6_quality_classifier,
    op7_decontamination,
    op8_byte_bpe,
    op9_warc,
    op10_pii,
    op11_periodic_runs,
    op12_conversation_repair,
    op13_source_mix,
)}
SQL: dict[str, str] = {
    "op9_warc": WARC_SQL, "op12_conversation_repair": REPAIR_SQL, "op13_source_mix": MIX_SQL}
