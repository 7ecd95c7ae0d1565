"""All queries of the subpackage and their SQL counterparts."""

from tallyloom.llm import fingerprint, langid, line_dedup, mixing, ngram_join, packing, phrases, quality, repair, secret_scan, sharding, substring, vectors  # noqa: F401
from tallyloom.llm.common import ORACLES, QUERIES  # noqa: F401
