"""Operators for large text corpora: near-dedup, licences, chats, languages, decontamination, secrets, quality, packing, line dedup, toxicity."""
