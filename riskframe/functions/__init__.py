"""Column-level building blocks: rule tables, clinical presets, text expressions."""
