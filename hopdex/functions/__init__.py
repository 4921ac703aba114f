"""Column-level building blocks: text, URL and markup expressions."""
