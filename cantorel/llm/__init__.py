"""Training-data operators: resampling, dedup, search, archives, PII, chat, packing, toxicity.

Nothing outside this subpackage imports it; it imports nothing else of the library.
"""
