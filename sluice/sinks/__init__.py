"""Writing: XML files with envelopes, tables, and delivery of written files."""
