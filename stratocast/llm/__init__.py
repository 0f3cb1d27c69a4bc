"""Training-data operators for very large text corpora (nothing else in the library imports this package)."""
