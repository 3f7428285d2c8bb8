"""Whole flows: understand, audit, prepare, train, evaluate."""
