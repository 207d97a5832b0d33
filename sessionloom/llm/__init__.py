"""Training-data operators for text; nothing outside this subpackage imports it."""
