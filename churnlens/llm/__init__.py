"""Training-data operators (decontamination, near-duplicates, extraction, PII, LM scoring, ...).

Nothing else in the library imports this package; ``__spark_entry__`` registers its queries when
the package is present.
"""
