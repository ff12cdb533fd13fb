"""Column-expression builders: parsing, validation and output formats."""
