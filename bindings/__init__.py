"""Bindings of the operators to the shared test tables: views, registered queries and their SQL oracles."""
