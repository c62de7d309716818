"""Training-data operators: near-duplicates, scoring, personal data, search, tokens, language.

One module per operator; `queries` holds the thin registered queries. Nothing outside this
subpackage (and `corpus_pipeline.py`) imports it.
"""
