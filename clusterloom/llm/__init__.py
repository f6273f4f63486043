"""Operators for preparing training text: filters, near duplicates, decontamination, personal data, mixing."""
