"""Operators for preparing language-model training data (archives, mixing, licences, token counts,
decontamination, language, quality, near copies of lines, texts and vectors)."""
