"""Training-data operators: quality rules, main-text extraction, URL filters,
WARC files, BPE, n-gram Jaccard join, repeated-passage removal, language ID,
license scans and benchmark decontamination.

Each module holds one operator with its own interface; ``queries`` binds the
operators to the driver's tables.  Nothing else in the library imports this
subpackage.
"""
