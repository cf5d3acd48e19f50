"""Input discovery, readers, validation and sinks."""
