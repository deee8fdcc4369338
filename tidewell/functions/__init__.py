"""Scoring and validation formulas as Spark SQL expressions.

A formula takes column names (or expressions) and returns expression text for ``selectExpr``,
``F.expr`` or SQL.  Everything is built-in functions, so it stays inside code generation, and a long
formula reaches the JVM in one call.
"""
