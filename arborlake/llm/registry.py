"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import centroids, decontaminate, divergence, embed_dedup, line_dedup, minhash, mixing, oracles, packing, secrets, token_counts, token_output, toxicity, url_filter

QUERIES = {
    "op1_token_output": token_output.query,
    "op2_line_dedup": line_dedup.query,
    "op3_decontaminate": decontaminate.query,
    "op4_mixing": mixing.query,
    "op5_embed_dedup": embed_dedup.query,
    "op6_toxicity": toxicity.query,
    "op7_secrets": secrets.query,
    "op8_url_filter": url_filter.query,
    "op9_minhash": minhash.query,
    "op10_token_counts": token_counts.query,
    "op11_divergence": divergence.query,
    "op12_centroids": centroids.query,
    "op13_packing": packing.query,
}

#: The others need a vocabulary (1, 10, 13), learning (6) or the entropy of values (7).
SQL: dict[str, str] = oracles.SQL
