"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonepulse.llm.bpe import op7_bpe_round_trip
from zonepulse.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from zonepulse.llm.html_text import op8_html_extraction
from zonepulse.llm.langid import op6_language_id
from zonepulse.llm.license_scan import op10_license_scan
from zonepulse.llm.merkle import op5_merkle_fingerprint
from zonepulse.llm.mixing import op1_mix_sources
from zonepulse.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from zonepulse.llm.quality import op4_quality_rules
from zonepulse.llm.secret_scan import op9_secret_scan
from zonepulse.llm.simhash import op3_simhash_dedup
from zonepulse.llm.suffix_dedup import op2_suffix_dedup
from zonepulse.llm.url_filter import op11_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_merkle_fingerprint": op5_merkle_fingerprint,
    "op6_language_id": op6_language_id,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_html_extraction": op8_html_extraction,
    "op9_secret_scan": op9_secret_scan,
    "op10_license_scan": op10_license_scan,
    "op11_url_filter": op11_url_filter,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op12_hard_negatives": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
