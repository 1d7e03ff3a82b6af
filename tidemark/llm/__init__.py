"""Operators for preparing training text: dedup, filters, language, toxicity, decontamination, mixing."""
