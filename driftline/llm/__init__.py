"""Operators for preparing training data: documents, pages, embeddings and conversations in, decisions and files out."""
