"""Scalar column functions; everything but the tree walk stays in the JVM."""
