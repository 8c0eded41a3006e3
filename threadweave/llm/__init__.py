"""Operators for preparing language-model training data.

Each module holds one operator with its general interface; ``queries`` holds
the registered ``opN_<name>`` queries over the ``documents`` table.  Nothing
else in the library imports this subpackage.
"""
