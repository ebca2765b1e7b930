"""Registered queries: each one reads the shared test tables through the
stand-in mapping (tidemark.sources.standin) and runs the library's operators."""
