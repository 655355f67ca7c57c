"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from linewatch.llm.cutting_stock import op9_cutting_stock
from linewatch.llm.label_shards import op2_label_shards
from linewatch.llm.line_frequency import OP10_SQL, op10_site_lines
from linewatch.llm.multi_order_join import OP6_SQL, op6_multi_order_join
from linewatch.llm.phrase_counting import OP12_SQL, op12_phrase_counting
from linewatch.llm.piece_viterbi import op4_piece_viterbi
from linewatch.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from linewatch.llm.range_coder import op5_range_coder
from linewatch.llm.repetition import op1_repetition
from linewatch.llm.simhash_trie import op13_simhash_trie
from linewatch.llm.span_language import op8_span_language
from linewatch.llm.sparse_suffixes import OP7_SQL, op7_repeated_passages
from linewatch.llm.vantage_trees import op3_vantage_trees

REGISTRY = {
    "op1_repetition": op1_repetition,
    "op2_label_shards": op2_label_shards,
    "op3_vantage_trees": op3_vantage_trees,
    "op4_piece_viterbi": op4_piece_viterbi,
    "op5_range_coder": op5_range_coder,
    "op6_multi_order_join": op6_multi_order_join,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_span_language": op8_span_language,
    "op9_cutting_stock": op9_cutting_stock,
    "op10_site_lines": op10_site_lines,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_phrase_counting": op12_phrase_counting,
    "op13_simhash_trie": op13_simhash_trie,
}

ORACLE = {
    "op6_multi_order_join": OP6_SQL,
    "op7_repeated_passages": OP7_SQL,
    "op10_site_lines": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_phrase_counting": OP12_SQL,
}
