"""Readers for documents, token records, predictions and lexicons."""
