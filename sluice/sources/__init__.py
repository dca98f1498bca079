"""Reading files: lines with provenance, declared CSV, listings, slices, XML."""
