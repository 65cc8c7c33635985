"""Loads every module of the subpackage that registers a query."""

from tidewater.llm import chat_format, collocations, compress_quality, dart_minhash, filter_audit, fingerprint, license_scan, mixing, ngram_join, quality_rules, sentencepiece_scan, toxicity, url_cascade  # noqa: F401
from tidewater.llm.base import ORACLE, QUERIES  # noqa: F401
