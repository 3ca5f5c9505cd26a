"""Column-expression building blocks (no UDFs): business rules of the
snapshot (F1-F17), value formatting and reason phrases, header names."""
