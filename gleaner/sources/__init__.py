"""Tables, derived views, file scans and sinks."""
