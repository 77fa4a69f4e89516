"""Input bindings, the query catalogue and its SQL counterparts."""
