"""The queries of these operators, over whole tables, and their SQL where SQL can express them."""

from millrace.llm.langid import op5_language_id
from millrace.llm.lines import OP7_SQL, op7_line_dedup
from millrace.llm.mixing import OP10_SQL, op10_mixing
from millrace.llm.negatives import OP13_SQL, op13_hard_negatives
from millrace.llm.neardup import op9_ngram_jaccard_join
from millrace.llm.packing import op6_packing
from millrace.llm.quality import op4_quality_rules
from millrace.llm.runs import op11_periodic_runs
from millrace.llm.secrets import op12_secret_scan
from millrace.llm.substrings import op2_suffix_array_dedup
from millrace.llm.topk import OP3_SQL, op3_exact_topk
from millrace.llm.toxicity import op1_toxicity
from millrace.llm.urls import op8_url_filters

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_exact_topk": op3_exact_topk,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_packing": op6_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_secret_scan": op12_secret_scan,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES = {"op3_exact_topk": OP3_SQL, "op7_line_dedup": OP7_SQL, "op10_mixing": OP10_SQL, "op13_hard_negatives": OP13_SQL}
