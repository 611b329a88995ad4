"""The registered queries of the operators, and the SQL of those that SQL can state."""

from __future__ import annotations

from earshot.llm.decontamination import SQL as DECONTAMINATION_SQL
from earshot.llm.decontamination import op7_decontamination
from earshot.llm.languages import op6_language
from earshot.llm.lines import SQL as LINES_SQL
from earshot.llm.lines import op4_line_dedup
from earshot.llm.mixing import SQL as MIXING_SQL
from earshot.llm.mixing import op10_mixing
from earshot.llm.negatives import SQL as NEGATIVES_SQL
from earshot.llm.negatives import op12_hard_negatives
from earshot.llm.packing import op11_token_files
from earshot.llm.pieces import op8_token_count
from earshot.llm.quality import op2_quality
from earshot.llm.sharding import SQL as SHARDING_SQL
from earshot.llm.sharding import op5_sharding
from earshot.llm.similarity import SQL as SIMILARITY_SQL
from earshot.llm.similarity import op9_jaccard_join
from earshot.llm.toxicity import op1_toxicity
from earshot.llm.urls import SQL as URLS_SQL
from earshot.llm.urls import op3_url_filter
from earshot.llm.whitening import op13_whitening

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_url_filter": op3_url_filter,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_language": op6_language,
    "op7_decontamination": op7_decontamination,
    "op8_token_count": op8_token_count,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_mixing": op10_mixing,
    "op11_token_files": op11_token_files,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}
ORACLES = {
    "op4_line_dedup": LINES_SQL,
    "op7_decontamination": DECONTAMINATION_SQL,
    "op3_url_filter": URLS_SQL,
    "op5_sharding": SHARDING_SQL,
    "op9_jaccard_join": SIMILARITY_SQL,
    "op10_mixing": MIXING_SQL,
    "op12_hard_negatives": NEGATIVES_SQL,
}
