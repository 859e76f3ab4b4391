"""Training-data operators: language, licences, extraction, deduplication, tokens, chat, leaks, archives."""
