"""The registered queries of this subpackage and their SQL."""

from adlens.llm.alignment import op13_cross_tokenizer_alignment
from adlens.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from adlens.llm.extraction import op11_html_extraction
from adlens.llm.importance import op3_quality_classifier
from adlens.llm.language_id import op5_language_id
from adlens.llm.language_model import op7_lm_scoring
from adlens.llm.lexical_search import OP12_SQL, op12_lexical_search
from adlens.llm.mixing import op4_mixing
from adlens.llm.near_dedup import op10_near_dedup
from adlens.llm.quality_rules import OP2_SQL, op2_quality_rules
from adlens.llm.quotation import op9_chat_formatting
from adlens.llm.segmentation import op6_sentencepiece
from adlens.llm.sharding import op1_sharding

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality_rules": op2_quality_rules,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_near_dedup": op10_near_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_lexical_search": op12_lexical_search,
    "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
}
ORACLE_SQL = {
    "op2_quality_rules": OP2_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op12_lexical_search": OP12_SQL,
}
