"""The registered queries: one per operator, each beside its SQL."""
