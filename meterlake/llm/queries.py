"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from meterlake.llm.alignment import op12_alignment
from meterlake.llm.bpe import op9_bpe
from meterlake.llm.decontaminate import op7_decontaminate
from meterlake.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from meterlake.llm.language_id import op5_language_id
from meterlake.llm.pieces import op11_sentencepiece
from meterlake.llm.pii import op10_pii
from meterlake.llm.quality import op8_quality
from meterlake.llm.simhash import op6_simhash
from meterlake.llm.spelling import op13_spelling
from meterlake.llm.substring_dedup import op2_substring_dedup
from meterlake.llm.token_counts import op3_token_counts
from meterlake.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_warc": op4_warc,
    "op5_language_id": op5_language_id,
    "op6_simhash": op6_simhash,
    "op7_decontaminate": op7_decontaminate,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_pii": op10_pii,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_alignment": op12_alignment,
    "op13_spelling": op13_spelling,
}

SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op4_warc": OP4_SQL,
}
