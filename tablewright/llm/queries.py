"""The operators' registered queries, one for each operator, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from . import bpe, html_extract, hpylm, langid, license_scan, near_dedup, packing, quality, topk, url_filter

QUERIES: dict[str, Callable[..., DataFrame]] = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_topk": topk.op3_topk,
    "op4_html_text": html_extract.op4_html_text,
    "op5_packing": packing.op5_packing,
    "op6_langid": langid.op6_langid,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_quality": quality.op8_quality,
    "op9_bpe": bpe.op9_bpe,
    "op10_lm_score": hpylm.op10_lm_score,
}

ORACLE: dict[str, str] = {
    "op1_near_dedup": near_dedup.OP1_SQL,
    "op2_url_filter": url_filter.OP2_SQL,
    "op3_topk": topk.OP3_SQL,
    "op7_license_scan": license_scan.OP7_SQL,
    "op8_quality": quality.OP8_SQL,
}
