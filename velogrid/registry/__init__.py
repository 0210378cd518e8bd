"""Every registered query and its SQL counterpart."""
