"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from carebase.llm.bpe import op12_bpe
from carebase.llm.decontaminate import OP3_SQL, op3_decontamination
from carebase.llm.licenses import op10_license_scan
from carebase.llm.main_text import op2_main_text
from carebase.llm.manifest import OP13_SQL, op13_manifest
from carebase.llm.merkle import op8_merkle
from carebase.llm.mixing import OP4_SQL, op4_source_mix
from carebase.llm.near_duplicates import op9_near_duplicates
from carebase.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from carebase.llm.pseudonyms import op6_pseudonyms
from carebase.llm.secret_links import op5_secret_scan
from carebase.llm.url_filter import op1_url_filter
from carebase.llm.weak_quality import op7_weak_quality

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_main_text": op2_main_text,
    "op3_decontamination": op3_decontamination,
    "op4_source_mix": op4_source_mix,
    "op5_secret_scan": op5_secret_scan,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_weak_quality": op7_weak_quality,
    "op8_merkle": op8_merkle,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_license_scan": op10_license_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe": op12_bpe,
    "op13_manifest": op13_manifest,
}

# Operators with fitted models or permutations are tested against brute force in tests/llm.
ORACLE_SQL = {
    "op3_decontamination": OP3_SQL,
    "op4_source_mix": OP4_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_manifest": OP13_SQL,
}
