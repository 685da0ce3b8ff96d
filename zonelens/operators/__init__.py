"""Table-in / table-out operators."""
