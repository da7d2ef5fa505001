"""Operators on text corpora for training data: filters, classifiers, joins, mixing and audits."""
