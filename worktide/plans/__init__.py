"""The query catalogue over the TPC-H-like test tables and its SQL oracles."""
