"""The per-document transforms on streams, with mergeable partial counts."""
