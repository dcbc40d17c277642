"""The registered queries of the package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapmart.llm.chat import op7_transcript_hmm
from snapmart.llm.fm_dedup import op6_fm_index_dedup
from snapmart.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from snapmart.llm.mixing import OP3_SQL, op3_source_mixing
from snapmart.llm.packing import op9_sum_of_squares_packing
from snapmart.llm.pii import op10_skip_chain_crf
from snapmart.llm.quality import OP2_SQL, op2_quality_cascade
from snapmart.llm.sharding import op5_hypergeometric_sharding
from snapmart.llm.simhash_dedup import op4_simhash_deletion_variants
from snapmart.llm.spelling import OP13_SQL, op13_spelling_variants
from snapmart.llm.suffix_dedup import op1_suffix_array_dedup
from snapmart.llm.topk_search import OP8_SQL, op8_maxscore_search
from snapmart.llm.warc import OP12_SQL, op12_warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_quality_cascade": op2_quality_cascade,
    "op3_source_mixing": op3_source_mixing,
    "op4_simhash_deletion_variants": op4_simhash_deletion_variants,
    "op5_hypergeometric_sharding": op5_hypergeometric_sharding,
    "op6_fm_index_dedup": op6_fm_index_dedup,
    "op7_transcript_hmm": op7_transcript_hmm,
    "op8_maxscore_search": op8_maxscore_search,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
    "op10_skip_chain_crf": op10_skip_chain_crf,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_warc_round_trip": op12_warc_round_trip,
    "op13_spelling_variants": op13_spelling_variants,
}

#: Equivalent SQL for DuckDB, where SQL can express a query in reasonable time.
SQL: dict[str, str] = {
    "op2_quality_cascade": OP2_SQL,
    "op3_source_mixing": OP3_SQL,
    "op8_maxscore_search": OP8_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_warc_round_trip": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
