"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from tessera.llm.bpe import op5_bpe
from tessera.llm.caps import ORACLE_SQL as CAPS_SQL
from tessera.llm.caps import op3_caps
from tessera.llm.covertree import ORACLE_SQL as TOPK_SQL
from tessera.llm.covertree import op2_topk
from tessera.llm.language import op1_language
from tessera.llm.minhash import ORACLE_SQL as MINHASH_SQL
from tessera.llm.minhash import op4_minhash
from tessera.llm.packing import op10_packing
from tessera.llm.pii import op6_pii
from tessera.llm.quality import op9_quality
from tessera.llm.secrets import ORACLE_SQL as SECRETS_SQL
from tessera.llm.secrets import op8_secrets
from tessera.llm.warc import ORACLE_SQL as WARC_SQL
from tessera.llm.warc import op7_warc

QUERIES = {
    "op1_language": op1_language,
    "op2_topk": op2_topk,
    "op3_caps": op3_caps,
    "op4_minhash": op4_minhash,
    "op5_bpe": op5_bpe,
    "op6_pii": op6_pii,
    "op7_warc": op7_warc,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
}

ORACLE_SQL: dict[str, str] = {"op2_topk": TOPK_SQL, "op3_caps": CAPS_SQL, "op4_minhash": MINHASH_SQL, "op7_warc": WARC_SQL, "op8_secrets": SECRETS_SQL}
