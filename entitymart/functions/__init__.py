"""Column expressions over decoded entities."""
