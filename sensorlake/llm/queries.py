"""Registered queries of this package and their SQL."""

from __future__ import annotations

from sensorlake.llm.bpe import op10_byte_bpe
from sensorlake.llm.decontamination import OP13_SQL, op13_benchmark_decontamination
from sensorlake.llm.filter_audit import OP12_SQL, op12_filter_audit
from sensorlake.llm.language_id import op7_language_id
from sensorlake.llm.lexical_search import OP11_SQL, op11_ranked_search
from sensorlake.llm.license_scan import op3_license_scan
from sensorlake.llm.mtree import OP2_SQL, op2_mtree_top_k
from sensorlake.llm.packing import op9_best_fit_packing
from sensorlake.llm.quality_rules import OP1_SQL, op1_quality_rules
from sensorlake.llm.secret_scan import op4_secret_scan
from sensorlake.llm.simhash import op6_simhash_near_dedup
from sensorlake.llm.substring_dedup import op5_substring_dedup
from sensorlake.llm.url_filter import op8_url_filter

QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_mtree_top_k, op3_license_scan, op4_secret_scan, op5_substring_dedup, op6_simhash_near_dedup,
    op7_language_id, op8_url_filter, op9_best_fit_packing, op10_byte_bpe, op11_ranked_search, op12_filter_audit,
    op13_benchmark_decontamination)}

ORACLE = {"op1_quality_rules": OP1_SQL, "op2_mtree_top_k": OP2_SQL, "op11_ranked_search": OP11_SQL, "op12_filter_audit": OP12_SQL,
          "op13_benchmark_decontamination": OP13_SQL}
