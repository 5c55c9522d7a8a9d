"""DataFrame operators of the corpus."""
