"""Column factories: decoders, timestamp extractors, split ids and routing."""
