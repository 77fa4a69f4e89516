"""Writers: versioned replace, keyed insert, append."""
