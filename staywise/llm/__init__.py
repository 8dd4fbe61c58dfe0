"""Operators for preparing training data: packing, deduplication, joins on
similarity, mixing, secret scans, token counts, language and quality models,
exact vector search.  Nothing outside this folder imports it."""
