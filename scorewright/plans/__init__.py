"""End-to-end jobs (nightly scoring), the derived run history, and the registry of checked queries."""
