"""The registered queries of this package and the SQL they are checked against."""

import corpus_pipeline
from ledgerlark.llm.decontaminate import decontaminate_query
from ledgerlark.llm.divergence import DIVERGENCE_SQL, divergence_query
from ledgerlark.llm.impact_search import IMPACT_SEARCH_SQL, impact_search_query
from ledgerlark.llm.lattice import LATTICE_SQL, lattice_query
from ledgerlark.llm.line_dedup import LINE_DEDUP_SQL, line_dedup_query
from ledgerlark.llm.ngram_join import NGRAM_JOIN_SQL, ngram_join_query
from ledgerlark.llm.pieces import pieces_query
from ledgerlark.llm.pii import PII_SQL, pii_query
from ledgerlark.llm.quality import quality_query
from ledgerlark.llm.reversed_search import REVERSED_SEARCH_SQL, reversed_search_query
from ledgerlark.llm.sentence_spans import SENTENCE_SPANS_SQL, sentence_spans_query
from ledgerlark.llm.suffix_dedup import SUFFIX_DEDUP_SQL, suffix_dedup_query
from ledgerlark.llm.toxicity import toxicity_query

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_ngram_join": ngram_join_query,
    "op2_pii": pii_query,
    "op3_line_dedup": line_dedup_query,
    "op4_quality": quality_query,
    "op5_decontaminate": decontaminate_query,
    "op6_sentence_spans": sentence_spans_query,
    "op7_pieces": pieces_query,
    "op8_toxicity": toxicity_query,
    "op9_lattice": lattice_query,
    "op10_suffix_dedup": suffix_dedup_query,
    "op11_reversed_search": reversed_search_query,
    "op12_impact_search": impact_search_query,
    "op13_divergence": divergence_query,
}

ORACLE = {
    "op1_ngram_join": NGRAM_JOIN_SQL,
    "op2_pii": PII_SQL,
    "op3_line_dedup": LINE_DEDUP_SQL,
    "op6_sentence_spans": SENTENCE_SPANS_SQL,
    "op9_lattice": LATTICE_SQL,
    "op10_suffix_dedup": SUFFIX_DEDUP_SQL,
    "op11_reversed_search": REVERSED_SEARCH_SQL,
    "op12_impact_search": IMPACT_SEARCH_SQL,
    "op13_divergence": DIVERGENCE_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
