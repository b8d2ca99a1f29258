"""The queries of this folder and their DuckDB statements."""

from __future__ import annotations

from netvigil.llm.best_fit_packing import op3_best_fit_packing
from netvigil.llm.exact_dedup import ORACLE as EXACT_DEDUP_SQL
from netvigil.llm.exact_dedup import op6_exact_dedup
from netvigil.llm.importance_sampling import op13_importance_sampling
from netvigil.llm.license_scan import op4_license_scan
from netvigil.llm.license_scan import oracle as license_scan_sql
from netvigil.llm.nn_descent import op7_nn_descent
from netvigil.llm.pu_toxicity import op2_pu_toxicity
from netvigil.llm.quality_gam import op9_quality_gam
from netvigil.llm.scan_bpe import op12_scan_bpe
from netvigil.llm.sentencepiece_codec import op1_sentencepiece
from netvigil.llm.signature_join import op5_signature_join
from netvigil.llm.site_style import op10_site_style
from netvigil.llm.spelling_variants import op11_spelling_variants
from netvigil.llm.wavelet_ids import op8_wavelet_ids

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_pu_toxicity": op2_pu_toxicity,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_license_scan": op4_license_scan,
    "op5_signature_join": op5_signature_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_nn_descent": op7_nn_descent,
    "op8_wavelet_ids": op8_wavelet_ids,
    "op9_quality_gam": op9_quality_gam,
    "op10_site_style": op10_site_style,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_scan_bpe": op12_scan_bpe,
    "op13_importance_sampling": op13_importance_sampling,
}
ORACLE_SQL: dict[str, str] = {
    "op4_license_scan": license_scan_sql(),
    "op6_exact_dedup": EXACT_DEDUP_SQL,
}
