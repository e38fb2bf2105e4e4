"""Operators for building language-model training data at corpus scale.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
