"""Training-data operators at corpus scale (nothing else in the library imports this subpackage)."""
