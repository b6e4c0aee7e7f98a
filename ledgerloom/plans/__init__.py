"""Session set-up, shared storage, plan inspection and the registered queries."""
