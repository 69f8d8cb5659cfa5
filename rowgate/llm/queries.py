"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowgate.llm import oracle
from rowgate.llm.filter_audit import op13_filter_audit
from rowgate.llm.itq import op12_itq_dedup
from rowgate.llm.kronecker import op11_kronecker_negatives
from rowgate.llm.license_scan import op9_license_scan
from rowgate.llm.line_frequency import op1_line_frequency
from rowgate.llm.mixing import op5_pareto_mix
from rowgate.llm.ngram_join import op6_lsh_forest_join
from rowgate.llm.permutation_index import op3_permutation_index
from rowgate.llm.sentencepiece_bpe import op8_sentencepiece
from rowgate.llm.substring_dedup import op2_rlz_dedup
from rowgate.llm.token_counts import op7_token_counts
from rowgate.llm.token_files import op10_token_files
from rowgate.llm.toxicity import op4_toxicity_mil

QUERIES = {f.__name__: f for f in (
    op1_line_frequency,
    op2_rlz_dedup,
    op3_permutation_index,
    op4_toxicity_mil,
    op5_pareto_mix,
    op6_lsh_forest_join,
    op7_token_counts,
    op8_sentencepiece,
    op9_license_scan,
    op10_token_files,
    op11_kronecker_negatives,
    op12_itq_dedup,
    op13_filter_audit,
)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
