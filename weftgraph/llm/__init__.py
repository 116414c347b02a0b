"""Operators for preparing training text: one module each, over DataFrames of documents, pages or vectors."""
