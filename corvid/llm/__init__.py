"""Training-data operators: chat formatting, source mixing, sampled SentencePiece encoding,
document fingerprints, language-model scores, quality rules, substring dedup, licence
scans, toxicity and SimHash near-dedup. Nothing else in the library imports this package.
"""
