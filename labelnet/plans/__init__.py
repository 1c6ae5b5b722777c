"""Compositions of operators into end-to-end flows and the named query registry."""
