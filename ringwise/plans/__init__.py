"""User-facing analyses built from the operators, each with a SQL oracle."""
