"""Column expressions: values, result envelopes, script texts."""
