"""Expressions as Spark SQL text.

Text is parsed once on the JVM side, where a tree of Column objects costs a
Python-to-JVM call per node. Only built-in functions are used, so plans stay
in generated code.
"""
