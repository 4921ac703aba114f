"""The same index, kept up to date while pages keep arriving."""
