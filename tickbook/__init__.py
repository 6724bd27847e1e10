"""tickbook."""
