"""The queries of this subpackage and their oracle SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.chat import OP5_SQL, op5_tool_calls
from millrace.llm.decontaminate import OP7_SQL, op7_decontaminate
from millrace.llm.jaccard_join import OP3_SQL, op3_ngram_jaccard
from millrace.llm.langid import op6_language
from millrace.llm.mixing import op1_mixing
from millrace.llm.mtree import OP4_SQL, op4_mtree_topk
from millrace.llm.pii import op9_pii
from millrace.llm.quality import op10_quality
from millrace.llm.runs import op11_periodic_runs
from millrace.llm.search import OP13_SQL, op13_lexical_search
from millrace.llm.simhash import op12_simhash
from millrace.llm.substrings import op2_substring_dedup
from millrace.llm.tokens import op8_token_ids


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_ngram_jaccard": op3_ngram_jaccard,
        "op4_mtree_topk": op4_mtree_topk,
        "op5_tool_calls": op5_tool_calls,
        "op6_language": op6_language,
        "op7_decontaminate": op7_decontaminate,
        "op8_token_ids": op8_token_ids,
        "op9_pii": op9_pii,
        "op10_quality": op10_quality,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_simhash": op12_simhash,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_ngram_jaccard": OP3_SQL, "op4_mtree_topk": OP4_SQL, "op5_tool_calls": OP5_SQL, "op7_decontaminate": OP7_SQL,
        "op13_lexical_search": OP13_SQL,
    }
