"""Queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from . import centroids, chat, decontam, embed_dedup, license_scan, merkle, minhash, mixing
from .centroids import op11_centroid_clustering
from .chat import op8_chat_format
from .decontam import op10_decontamination
from .embed_dedup import op6_embedding_dedup
from .html_extract import op7_html_extraction
from .lang_id import op1_language_id
from .license_scan import op13_license_scan
from .line_dedup import op2_line_dedup
from .merkle import op12_merkle_manifest
from .minhash import op4_minhash_near_dedup
from .mixing import op5_mixing
from .token_counts import op3_token_counts
from .token_output import op9_token_output

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_mixing": op5_mixing,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_chat_format": op8_chat_format,
    "op9_token_output": op9_token_output,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_license_scan": op13_license_scan,
}

ORACLES: dict[str, str] = {
    "op4_minhash_near_dedup": minhash.SQL,
    "op5_mixing": mixing.SQL,
    "op6_embedding_dedup": embed_dedup.SQL,
    "op8_chat_format": chat.SQL,
    "op10_decontamination": decontam.SQL,
    "op11_centroid_clustering": centroids.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_license_scan": license_scan.SQL,
}
