"""Operators for building training data from documents, pages and embeddings; each module is one operator."""
