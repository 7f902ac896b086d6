"""Tables in and out: schema-enforced readers, sinks, file-backed rows."""
