"""Training-data operators: deduplication, decontamination, classifiers, PII, tokenisation.

Nothing else in the library imports this subpackage. It borrows only general
helpers (the checkpoint folder, ``freeze``) from ``trackyard.session``.
"""
