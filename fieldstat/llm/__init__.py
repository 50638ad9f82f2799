"""Training-data operators: ten text and vector operators for corpus preparation.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_*`` queries over the driver tables. Nothing else in
the library imports this package.
"""
