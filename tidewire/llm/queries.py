"""Queries of the training-data operators and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from tidewire.llm.bpe import op3_bpe
from tidewire.llm.chat import SQL as CHAT_SQL
from tidewire.llm.chat import op5_chat
from tidewire.llm.embedding_dedup import op10_embedding_dedup
from tidewire.llm.hpylm import op7_lm
from tidewire.llm.html_extract import op9_html
from tidewire.llm.minhash import op4_minhash
from tidewire.llm.packing import op1_packing
from tidewire.llm.pii import op6_pii
from tidewire.llm.quality import op8_quality
from tidewire.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_bpe": op3_bpe,
    "op4_minhash": op4_minhash,
    "op5_chat": op5_chat,
    "op6_pii": op6_pii,
    "op7_lm": op7_lm,
    "op8_quality": op8_quality,
    "op9_html": op9_html,
    "op10_embedding_dedup": op10_embedding_dedup,
}
SQL: dict[str, str] = {"op5_chat": CHAT_SQL}
