"""Training-data operators: scans, deduplication, classifiers, mixing and formatting of text corpora.

Nothing outside this folder imports it, so it can be removed without touching the rest of the library.
"""
