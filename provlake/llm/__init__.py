"""Training-data operators on text.

Nothing outside this subpackage imports it; the driver contract adds its
queries only when it can be imported.
"""
