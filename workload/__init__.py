"""The library's operators run over the given tables, each with an independent SQL check."""
