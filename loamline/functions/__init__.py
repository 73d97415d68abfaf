"""Part of loamline."""
