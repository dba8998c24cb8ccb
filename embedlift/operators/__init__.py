"""DataFrame to DataFrame operators over records, mappings, states and logs."""
