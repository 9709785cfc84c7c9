"""Generic DataFrame operators: de-duplication, back-fill, references, visits, quality."""
