"""Readers and writers: article XML, article JSON, web pages, vector tables."""
