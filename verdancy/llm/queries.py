"""The opN_<name> queries of the training-data operators."""

from __future__ import annotations

from .html_extract import op13_html_extract
from .jaccard_join import op2_jaccard_join
from .language_id import op1_language_id
from .mil_quality import op7_mil_quality
from .name_join import ORACLE as OP12_SQL
from .name_join import op12_name_join
from .packing import op10_packing
from .pii_crf import op3_pii_crf
from .quality_rules import op9_quality_rules
from .substring_dedup import ORACLE as OP5_SQL
from .substring_dedup import op5_substring_dedup
from .token_align import op11_token_align
from .token_files import op4_token_files
from .topk_search import ORACLE as OP6_SQL
from .topk_search import op6_topk_search
from .trie_bpe import op8_trie_bpe

_QUERIES = [op1_language_id, op2_jaccard_join, op3_pii_crf, op4_token_files, op5_substring_dedup, op6_topk_search, op7_mil_quality, op8_trie_bpe, op9_quality_rules, op10_packing]
_QUERIES += [op11_token_align, op12_name_join, op13_html_extract]


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {op5_substring_dedup.__name__: OP5_SQL, op6_topk_search.__name__: OP6_SQL, op12_name_join.__name__: OP12_SQL}
