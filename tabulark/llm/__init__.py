"""Training-data operators: near-duplicate join, nearest neighbours, language
model, quality and toxicity scoring, tokenisation, token files, sharding, sanitising,
mixing, spelling variants, collocations.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``catalog`` registers the digest queries.
"""
