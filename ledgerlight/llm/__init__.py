"""Training-data operators: near duplicates, line and substring dedup, quality, PII, language, packing, mixing.

Nothing else in the library imports this package; ``queries`` registers its
queries. Intermediate tables go to the shared folder that the session names
in ``spark.checkpoint.dir`` (see ``shared``).
"""
