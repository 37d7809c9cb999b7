"""The numbered operators as queries over the given tables, and SQL twins for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratestar.llm.byte_bpe import op10_byte_bpe
from ratestar.llm.decontamination import OP9_SQL, op9_decontamination
from ratestar.llm.html_extract import op3_html_extract
from ratestar.llm.jaccard_join import OP2_SQL, op2_jaccard_join
from ratestar.llm.language_id import op4_language_id
from ratestar.llm.lexical_search import OP12_SQL, op12_lexical_search
from ratestar.llm.one_bit_search import OP5_SQL, op5_one_bit_search
from ratestar.llm.phrase_mining import OP11_SQL, op11_phrases
from ratestar.llm.substring_dedup import OP8_SQL, op8_substring_dedup
from ratestar.llm.token_files import op13_token_files
from ratestar.llm.toxicity import op1_toxicity
from ratestar.llm.url_filter import OP6_SQL, op6_url_filter
from ratestar.llm.warc_revisits import OP7_SQL, op7_warc_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_html_extract": op3_html_extract,
    "op4_language_id": op4_language_id,
    "op5_one_bit_search": op5_one_bit_search,
    "op6_url_filter": op6_url_filter,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_phrases": op11_phrases,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_files": op13_token_files,
}

ORACLES: dict[str, str] = {
    "op2_jaccard_join": OP2_SQL,
    "op5_one_bit_search": OP5_SQL,
    "op6_url_filter": OP6_SQL,
    "op7_warc_revisits": OP7_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_decontamination": OP9_SQL,
    "op11_phrases": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}
