"""Column functions: each takes and returns Spark columns and stays inside the JVM, but for
the entity step of :func:`starmill.functions.text.decode_entities` and :mod:`starmill.functions.dictionary`."""
