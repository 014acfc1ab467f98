"""Operators for preparing training text: near copies, archives, page text, mixing, licences, languages, secrets,
token counts, quality and benchmark passages. Nothing else in the library imports this subpackage."""
