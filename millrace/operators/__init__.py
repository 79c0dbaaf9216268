"""DataFrame → DataFrame operators over event tables."""
