"""The queries of this subpackage, by name, and their SQL twins."""

from __future__ import annotations

from .collocations import op11_collocations
from .decontaminate import op1_decontaminate
from .filter_audit import op13_filter_audit
from .jaccard_join import op9_jaccard_join
from .line_dedup import op3_line_dedup
from .lm_score import op7_lm_score
from .pii import op8_pii
from .quality_rank import op2_quality_rank
from .quality_rules import op4_quality_rules
from .secret_scan import op10_secret_scan
from .sentence_pieces import op6_sentence_pieces
from .sql import SQL as SQL
from .suffix_dedup import op12_suffix_dedup
from .token_counts import op5_token_counts

QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_quality_rank, op3_line_dedup, op4_quality_rules, op5_token_counts, op6_sentence_pieces, op7_lm_score, op8_pii, op9_jaccard_join, op10_secret_scan, op11_collocations, op12_suffix_dedup, op13_filter_audit)}
