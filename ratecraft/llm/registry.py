"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from ratecraft.llm import sql
from ratecraft.llm.op01_token_store import op1_token_store
from ratecraft.llm.op02_language import op2_language_id
from ratecraft.llm.op03_licenses import op3_license_scan
from ratecraft.llm.op04_collisions import op4_vector_dedup
from ratecraft.llm.op05_superminhash import op5_minhash_dedup
from ratecraft.llm.op06_edit_counts import op6_edit_counts
from ratecraft.llm.op07_decontam import op7_decontam
from ratecraft.llm.op08_mix import op8_mix_sources
from ratecraft.llm.op09_url_rules import op9_url_rules
from ratecraft.llm.op10_toxicity import op10_toxicity
from ratecraft.llm.op11_warc import op11_warc_index
from ratecraft.llm.op12_treap_search import op12_treap_search
from ratecraft.llm.op13_hard_negatives import op13_hard_negatives

QUERIES = {f.__name__: f for f in [
    op1_token_store, op2_language_id, op3_license_scan, op4_vector_dedup, op5_minhash_dedup, op6_edit_counts,
    op7_decontam, op8_mix_sources, op9_url_rules, op10_toxicity,
    op11_warc_index, op12_treap_search, op13_hard_negatives]}
ORACLE: dict[str, str] = dict(sql.ORACLE)
