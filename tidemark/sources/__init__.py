"""Bronze and Silver readers and the writers for every layer."""
