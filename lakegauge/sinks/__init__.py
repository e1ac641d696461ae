"""Writing. Every sink can be run again without changing its result."""
