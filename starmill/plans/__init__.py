"""The three hops (landing -> bronze -> silver -> gold) and the reads over the result."""
