"""Operators for training data: sharding, fingerprints, chat formatting, page
extraction, language, decontamination, secrets, quality, near copies, pieces."""
