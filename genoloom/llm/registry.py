"""The queries of this subpackage, by name."""

from __future__ import annotations

from .ann import op5_nearest_neighbours
from .chat import OP1_SQL, op1_chat_formatting
from .codebooks import OP13_SQL, op13_vector_codes
from .decontaminate import OP3_SQL, op3_benchmark_decontamination
from .language import op7_language_id
from .lm import op6_lm_scoring
from .packing import op2_best_fit_packing
from .pii import op4_pii
from .quantised import OP11_SQL, op11_embedding_near_dedup
from .simhash import op10_simhash_near_dedup
from .token_files import op8_token_files
from .toxicity import op9_toxicity
from .whitening import op12_embedding_whitening

QUERIES = {f.__name__: f for f in (op1_chat_formatting, op2_best_fit_packing, op3_benchmark_decontamination, op4_pii, op5_nearest_neighbours, op6_lm_scoring, op7_language_id, op8_token_files, op9_toxicity, op10_simhash_near_dedup,
                                     op11_embedding_near_dedup, op12_embedding_whitening, op13_vector_codes)}
ORACLE_SQL: dict[str, str] = {"op1_chat_formatting": OP1_SQL, "op3_benchmark_decontamination": OP3_SQL, "op11_embedding_near_dedup": OP11_SQL, "op13_vector_codes": OP13_SQL}
