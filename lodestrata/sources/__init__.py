"""Sources and sinks: full-text XML, the corpus store, injected responses."""
