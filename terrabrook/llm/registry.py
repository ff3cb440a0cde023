"""The corpus operators' queries and their DuckDB SQL."""

from . import chat, decontaminate, html_text, language, licenses, line_dedup, packing, pii, quality, simhash, suffix_dedup, vector_codes, whitening

QUERIES = {
    "op1_language_id": language.op1_language_id,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_simhash_dedup": simhash.op7_simhash_dedup,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_pii": pii.op9_pii,
    "op10_license_scans": licenses.op10_license_scans,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_html_text": html_text.op12_html_text,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {
    "op2_quality_rules": quality.OP2_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op6_chat_formatting": chat.OP6_SQL,
    "op8_suffix_dedup": suffix_dedup.OP8_SQL,
    "op11_vector_codes": vector_codes.OP11_SQL,
}
