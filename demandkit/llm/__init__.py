"""Operators that prepare training text: filter, deduplicate, decontaminate, encode, shard."""
