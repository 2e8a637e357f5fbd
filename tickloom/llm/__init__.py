"""Operators for training data: tokens, language, quality, near copies, extraction, chat, search, packing."""
