"""Operators for large text corpora: mixing, decontamination, token files,
language and toxicity models, language-model scoring, archives, duplicate
search and exact top-k. Nothing else in the package imports this subpackage."""
