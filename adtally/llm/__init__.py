"""Operators for preparing training corpora (text, pages, benchmark tables).

Nothing outside this subpackage imports it, except ``__spark_entry__.py`` and
``corpus_pipeline.py``. Each module holds one operator; ``queries`` registers
the thin queries over them.
"""
