"""Operators for large text collections. Nothing else in the library imports this subpackage."""
