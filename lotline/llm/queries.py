"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from lotline.llm.bpe import op8_bpe
from lotline.llm.centroids import OP12_SQL, op12_centroids
from lotline.llm.fingerprint import op3_fingerprints
from lotline.llm.langid import op9_langid
from lotline.llm.license_scan import OP11_SQL, op11_license_scan
from lotline.llm.near_dedup import OP7_SQL, op7_near_dedup
from lotline.llm.packing import op10_packing
from lotline.llm.spelling import OP13_SQL, op13_spelling
from lotline.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from lotline.llm.suffix_dedup import OP5_SQL, op5_suffix_dedup
from lotline.llm.topk import OP2_SQL, op2_exact_topk
from lotline.llm.toxicity import op4_toxicity
from lotline.llm.warc import OP6_SQL, op6_warc

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_warc": op6_warc,
    "op7_near_dedup": op7_near_dedup,
    "op8_bpe": op8_bpe,
    "op9_langid": op9_langid,
    "op10_packing": op10_packing,
    "op11_license_scan": op11_license_scan,
    "op12_centroids": op12_centroids,
    "op13_spelling": op13_spelling,
}
ORACLE_SQL = {
    "op1_substring_dedup": OP1_SQL,
    "op2_exact_topk": OP2_SQL,
    "op5_suffix_dedup": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op7_near_dedup": OP7_SQL,
    "op11_license_scan": OP11_SQL,
    "op12_centroids": OP12_SQL,
    "op13_spelling": OP13_SQL,
}
