"""End-to-end refreshes, derived test inputs and registered queries."""
