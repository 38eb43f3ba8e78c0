"""Training-data operators (numbered 1-13) and the queries over them.

Nothing else in the library imports this subpackage.
"""
