"""Column-level helpers: coercions, schema alias resolution, hashing, running windows."""
