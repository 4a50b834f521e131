"""Part of the cantorel engine."""
