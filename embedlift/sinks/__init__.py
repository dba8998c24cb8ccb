"""Writers: vendor shaped exports and versioned record collections."""
