"""Table definitions, master data, fixture views and the stored repository."""
