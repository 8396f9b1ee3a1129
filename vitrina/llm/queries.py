"""The registered queries of this subpackage and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from vitrina.llm.fingerprints import op10_fingerprints
from vitrina.llm.jaccard_join import OP12_SQL, op12_jaccard_join
from vitrina.llm.language_id import op3_language_id
from vitrina.llm.lexical_search import OP13_SQL, op13_lexical_search
from vitrina.llm.license_scan import op4_license_scan
from vitrina.llm.line_dedup import OP7_SQL, op7_line_dedup
from vitrina.llm.merkle_manifest import OP11_SQL, op11_merkle_manifest
from vitrina.llm.mixing import op8_mixing
from vitrina.llm.near_dedup import OP2_SQL, op2_near_dedup
from vitrina.llm.quality_classifier import op5_quality_classifier
from vitrina.llm.quality_rules import OP1_SQL, OP1_TEXT_SQL, op1_quality_rules, op1_remaining_text
from vitrina.llm.sentencepiece_codec import op6_sentencepiece
from vitrina.llm.suffix_dedup import OP9_SQL, op9_suffix_dedup

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op1_remaining_text": op1_remaining_text,
    "op2_near_dedup": op2_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_license_scan": op4_license_scan,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_line_dedup": op7_line_dedup,
    "op8_mixing": op8_mixing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL = {
    "op1_quality_rules": OP1_SQL,
    "op1_remaining_text": OP1_TEXT_SQL,
    "op2_near_dedup": OP2_SQL,
    "op7_line_dedup": OP7_SQL,
    "op9_suffix_dedup": OP9_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_jaccard_join": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
