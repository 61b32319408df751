"""The registered queries of this subpackage and their SQL."""

from pressloom.llm import (ann, bpe_codec, fill_middle, fingerprint, jaccard_join, license_scan, mixing, quality_rules, suffix_dedup, token_count,
                           url_filter, vector_codes, warc)

_MODULES = [ann, bpe_codec, suffix_dedup, license_scan, url_filter, warc, mixing, quality_rules, token_count, jaccard_join, fill_middle, fingerprint,
            vector_codes]
QUERIES = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}
