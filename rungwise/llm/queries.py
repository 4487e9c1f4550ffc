"""The registered queries of this subpackage; SQL where it can express them."""

from __future__ import annotations

from rungwise.llm.alignment import op11_alignment
from rungwise.llm.bpe import op6_bpe
from rungwise.llm.chat import OP1_SQL, op1_chat
from rungwise.llm.conversation_repair import OP13_SQL, op13_conversation_repair
from rungwise.llm.embed_dedup import OP2_SQL, op2_embed_dedup
from rungwise.llm.html_extract import op8_html_extract
from rungwise.llm.langid import op10_langid
from rungwise.llm.mixing import OP12_SQL, op12_mixing
from rungwise.llm.packing import op9_packing
from rungwise.llm.simhash import op7_simhash
from rungwise.llm.suffix_dedup import op5_suffix_dedup
from rungwise.llm.topk import OP4_SQL, op4_topk
from rungwise.llm.url_filter import OP3_SQL, op3_url_filter

QUERIES = {
    "op1_chat": op1_chat,
    "op2_embed_dedup": op2_embed_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_topk": op4_topk,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_html_extract": op8_html_extract,
    "op9_packing": op9_packing,
    "op10_langid": op10_langid,
    "op11_alignment": op11_alignment,
    "op12_mixing": op12_mixing,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE_SQL: dict[str, str] = {
    "op1_chat": OP1_SQL,
    "op2_embed_dedup": OP2_SQL,
    "op3_url_filter": OP3_SQL,
    "op4_topk": OP4_SQL,
    "op12_mixing": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
