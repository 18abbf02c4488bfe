"""Property listings shaped from the TPC-H-like tables, to exercise every operator."""
