"""Writers of result tables and serving copies."""
