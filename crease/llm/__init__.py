"""Training-data operators: sharding, chat formatting, personal data, licences,
near-duplicates, toxicity, language, decontamination, packing, URL filters,
conversation repair and centroid clusters.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query per operator and the pipeline of ``corpus_pipeline.py``.
"""
