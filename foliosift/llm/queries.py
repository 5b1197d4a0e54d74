"""The operators as queries on the given tables, with SQL where SQL can express them."""

import corpus_pipeline
from foliosift.llm.decontamination import op7_decontamination
from foliosift.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from foliosift.llm.html_text import op10_html_text
from foliosift.llm.language_model import op4_lm_scoring
from foliosift.llm.line_dedup import OP1_SQL, op1_line_dedup
from foliosift.llm.merkle import OP11_SQL, op11_merkle_manifest
from foliosift.llm.mixing import OP12_SQL, op12_source_mix
from foliosift.llm.near_dedup import op6_near_dedup
from foliosift.llm.packing import op2_packing
from foliosift.llm.quality import op8_quality_rules
from foliosift.llm.secrets import op3_secret_scan
from foliosift.llm.toxicity import op9_toxicity
from foliosift.llm.url_lists import OP5_SQL, op5_url_lists

QUERIES = {
    query.__name__: query
    for query in (
        op1_line_dedup,
        op2_packing,
        op3_secret_scan,
        op4_lm_scoring,
        op5_url_lists,
        op6_near_dedup,
        op7_decontamination,
        op8_quality_rules,
        op9_toxicity,
        op10_html_text,
        op11_merkle_manifest,
        op12_source_mix,
        op13_hard_negatives,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op5_url_lists": OP5_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_source_mix": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
