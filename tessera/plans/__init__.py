"""Compositions of the operators: layer loads, the star build, registered queries."""
