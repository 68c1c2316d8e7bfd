"""Queries and oracle SQL of this subpackage, for the registry."""

from __future__ import annotations

from .gif import op7_media_gif
from .mixing import OP2_SQL, op2_mixing_sources
from .pieces import op5_sentencepiece
from .pii import op1_pii
from .quality import op9_quality_classifier
from .secrets import OP6_SQL, op6_secret_scans
from .simhash import op10_simhash_near_dedup
from .substrings import OP4_SQL, op4_substring_dedup
from .tokencount import op3_token_counts
from .topk import OP8_SQL, op8_exact_top_k

QUERIES = {
    "op1_pii": op1_pii,
    "op2_mixing_sources": op2_mixing_sources,
    "op3_token_counts": op3_token_counts,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_secret_scans": op6_secret_scans,
    "op7_media_gif": op7_media_gif,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
}
ORACLES: dict[str, str] = {
    "op2_mixing_sources": OP2_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op6_secret_scans": OP6_SQL,
    "op8_exact_top_k": OP8_SQL,
}
