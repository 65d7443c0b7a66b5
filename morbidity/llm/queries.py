"""Registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from morbidity.llm.decontaminate import OP2_SQL, op2_decontamination
from morbidity.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from morbidity.llm.jaccard_join import OP3_SQL, op3_jaccard_join
from morbidity.llm.lang_id import op8_language_id
from morbidity.llm.line_dedup import op5_line_dedup
from morbidity.llm.mix import OP7_SQL, op7_source_mix
from morbidity.llm.quality import OP9_SQL, op9_quality_rules
from morbidity.llm.secrets import op10_secret_scan
from morbidity.llm.shard import op6_sharding
from morbidity.llm.suffix_dedup import op13_suffix_dedup
from morbidity.llm.token_align import op11_token_alignment
from morbidity.llm.token_count import op1_token_counts
from morbidity.llm.warc import OP4_SQL, op4_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_warc": op4_warc,
    "op5_line_dedup": op5_line_dedup,
    "op6_sharding": op6_sharding,
    "op7_source_mix": op7_source_mix,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_secret_scan": op10_secret_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op7_source_mix": OP7_SQL,
    "op9_quality_rules": OP9_SQL,
    "op12_hard_negatives": OP12_SQL,
}
