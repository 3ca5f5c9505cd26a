"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from functools import wraps

from tidemark.llm.bpe import op7_byte_bpe
from tidemark.llm.chat_format import op6_chat_format
from tidemark.llm.collocations import op12_collocations
from tidemark.llm.common import on_workers
from tidemark.llm.decontaminate import op9_decontaminate
from tidemark.llm.jaccard_join import op1_jaccard_join
from tidemark.llm.kneser_ney import op3_quality_classifier
from tidemark.llm.lexical_search import op11_lexical_search
from tidemark.llm.quality_rules import op10_quality_rules
from tidemark.llm.sentence_pieces import op13_sentence_pieces
from tidemark.llm.shard import op5_shard
from tidemark.llm.suffix_dedup import op2_suffix_dedup
from tidemark.llm.token_counts import op8_token_counts, token_counts_bpe
from tidemark.llm.token_shards import op4_token_shards


def _query(run):
    @wraps(run)
    def ready(spark, sf_dir):
        on_workers(spark)
        return run(spark, sf_dir)
    return ready


QUERIES = {name: _query(run) for name, run in {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_token_shards": op4_token_shards,
    "op5_shard": op5_shard,
    "op6_chat_format": op6_chat_format,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_counts": op8_token_counts,
    "token_counts_bpe": token_counts_bpe,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality_rules": op10_quality_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_collocations": op12_collocations,
    "op13_sentence_pieces": op13_sentence_pieces,
}.items()}
