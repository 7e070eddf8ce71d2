"""Part of folioframe."""
