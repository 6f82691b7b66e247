"""The subpackage's registered queries and their DuckDB twins."""

from __future__ import annotations

from tillwork.llm.bpe import op6_bpe
from tillwork.llm.contamination import op7_decontamination
from tillwork.llm.embeddings import op1_lattice
from tillwork.llm.hostrules import OP11_SQL, op11_host_rules
from tillwork.llm.language import op3_language_id
from tillwork.llm.licenses import op9_licenses, op9_sql
from tillwork.llm.neardup import op10_minhash
from tillwork.llm.quality import op5_quality
from tillwork.llm.ranking import OP13_SQL, op13_ranked_search
from tillwork.llm.repeats import op4_repeats
from tillwork.llm.sharding import op8_byte_shards
from tillwork.llm.toolcalls import OP2_SQL, op2_tool_calls
from tillwork.llm.turns import op12_turn_repair

QUERIES = {
    "op1_lattice": op1_lattice,
    "op2_tool_calls": op2_tool_calls,
    "op3_language_id": op3_language_id,
    "op4_repeats": op4_repeats,
    "op5_quality": op5_quality,
    "op6_bpe": op6_bpe,
    "op7_decontamination": op7_decontamination,
    "op8_byte_shards": op8_byte_shards,
    "op9_licenses": op9_licenses,
    "op10_minhash": op10_minhash,
    "op11_host_rules": op11_host_rules,
    "op12_turn_repair": op12_turn_repair,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op2_tool_calls": OP2_SQL,
    "op9_licenses": op9_sql(),
    "op11_host_rules": OP11_SQL,
    "op13_ranked_search": OP13_SQL,
}
