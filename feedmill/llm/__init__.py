"""Corpus preparation: ten operators over documents and web pages."""
