"""Report compositions (P1-P9), the query registry and its SQL oracles."""
