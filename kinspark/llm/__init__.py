"""Operations of a training-data pipeline over a table of documents.

Each module holds one operator with a general interface; ``queries`` holds the thin registered queries.
Rules that all operators share:

* a null text counts as the empty text; a null document id sorts before all others and is returned as null;
* columns beyond those an operator names are ignored, whatever they are called;
* an empty table gives an empty result with the usual columns.
"""
