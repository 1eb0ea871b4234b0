"""Bindings of the four-table model to source tables, and the named queries over them."""
