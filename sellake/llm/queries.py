"""Registered queries of the training-data operators and their DuckDB SQL."""

from . import op04_quality, op05_line_dedup, op07_warc, op11_minhash as op11, op12_audit, op13_negatives
from .op01_token_rollup import op1_token_rollup
from .op02_arrow_tokens import op2_arrow_tokens
from .op03_fingerprint import op3_fingerprints
from .op04_quality import op4_quality_rules
from .op05_line_dedup import op5_line_dedup
from .op06_ngram_join import op6_ngram_join
from .op07_warc import op7_warc
from .op08_sentencepiece import op8_sentencepiece
from .op09_language import op9_language
from .op10_packing import op10_packing
from .op11_minhash import op11_minhash
from .op12_audit import op12_filter_audit
from .op13_negatives import op13_hard_negatives

QUERIES = {
    "op1_token_rollup": op1_token_rollup,
    "op2_arrow_tokens": op2_arrow_tokens,
    "op3_fingerprints": op3_fingerprints,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_join": op6_ngram_join,
    "op7_warc": op7_warc,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language": op9_language,
    "op10_packing": op10_packing,
    "op11_minhash": op11_minhash,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE: dict[str, str] = {
    "op4_quality_rules": op04_quality.SQL,
    "op5_line_dedup": op05_line_dedup.SQL,
    "op7_warc": op07_warc.SQL,
    "op11_minhash": op11.SQL,
    "op12_filter_audit": op12_audit.SQL,
    "op13_hard_negatives": op13_negatives.SQL,
}
